"""Decisions that span operators: broadcast guards, shared pre-aggregates, intermediate tables and the full run."""
