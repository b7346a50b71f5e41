"""Query-performance telemetry warehouse on Spark."""
