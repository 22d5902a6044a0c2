"""Catalogue and schema governance as DataFrame operators on Spark."""
