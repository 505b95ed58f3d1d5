"""Surveil: health-surveillance analytics as Spark DataFrame jobs."""
