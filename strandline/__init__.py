"""Versioned metadata ingest and reconciliation as Spark DataFrame jobs."""

__version__ = "0.1.0"
