"""Audited event-level data models on PySpark."""
