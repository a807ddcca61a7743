"""Daybook: daily sales batches as Spark DataFrame jobs."""
