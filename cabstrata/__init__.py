"""Spark-first batch analytics over drifting, repeatedly delivered trip records."""

__version__ = "0.1.0"
