"""Market-bar analytics as Spark DataFrame jobs."""
