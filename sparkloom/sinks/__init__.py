"""Sinks, table definitions and run metrics."""
