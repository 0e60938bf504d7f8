"""Spark-native engine for nested-record ingestion and versioned tables."""

__version__ = "0.1.0"
