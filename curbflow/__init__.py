"""Batch analytics for ride-hailing trip records, expressed as Spark DataFrame jobs."""
