"""Maintenance analytics expressed as Spark DataFrame jobs."""
