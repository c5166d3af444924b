"""Data-quality checks and reconciliation of keyed tables and event streams on Spark."""
