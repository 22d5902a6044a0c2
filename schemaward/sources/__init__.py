"""Readers and writers for the engine's inputs, state tables and reports."""
