"""Spark operators, marts and reports for studying how scheduled trips run late."""

__version__ = "0.1.0"
