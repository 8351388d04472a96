"""Transit telemetry analytics expressed with DataFrames, SQL and Structured Streaming."""
