"""Retail transaction analytics as plain Spark DataFrame transformations."""
