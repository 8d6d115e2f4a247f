"""Spark-native engine for auditing large document estates."""

__version__ = "0.1.0"
