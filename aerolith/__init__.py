"""aerolith: event-time telemetry analytics expressed as PySpark DataFrame, SQL and Structured Streaming plans."""
