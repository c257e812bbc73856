"""Recommendation analytics expressed as Spark DataFrame jobs."""
