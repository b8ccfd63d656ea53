"""Machine-tool telemetry analytics on Spark DataFrames and Structured Streaming."""
