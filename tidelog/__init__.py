"""Web access-log analytics as DataFrame, Spark SQL and Structured Streaming jobs."""
