"""Staging, star schema, quality checks and reports as DataFrame plans."""
