"""Lazy, composable PySpark operators for retail sales analysis."""

__version__ = "0.1.0"
