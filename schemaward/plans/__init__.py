"""Whole jobs composed of operators, and the helpers that keep them skew-proof."""
