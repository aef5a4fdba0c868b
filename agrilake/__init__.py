"""Crop and weather analytics as Spark DataFrame jobs (bronze, silver, gold, star schema, reports)."""

__version__ = "0.1.0"
