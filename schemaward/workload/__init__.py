"""Registered queries over the driver's tables, with their comparison SQL."""
