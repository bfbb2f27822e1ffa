"""Cadenza: term reconciliation and schedule strings as Spark DataFrame operations."""
