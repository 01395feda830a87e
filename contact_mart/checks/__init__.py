"""Queries over the driver's tables, each with an equivalent DuckDB text."""
