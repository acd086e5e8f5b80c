"""Regulation catalogs on Spark: extraction, validation, diff, review and publication of field definitions."""
