"""Retail analytics on Spark: sources, staging, star schema, quality checks, reports."""

__version__ = "0.1.0"
