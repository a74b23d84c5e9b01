"""Electricity-grid analytics as lazy PySpark DataFrame operators."""

__all__ = ["constants", "functions", "operators", "plans", "schemas", "sources"]
