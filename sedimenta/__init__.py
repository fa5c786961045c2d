"""Layered (bronze, silver, gold) table builds with built-in data quality, on Spark."""
