"""Time-series, news and training-data analytics as Spark DataFrame jobs."""
