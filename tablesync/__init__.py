"""Incremental table synchronisation as Spark DataFrame jobs."""
