"""Layered market-price analytics on Spark: bronze, silver and gold tables,
quality checks and reports, in batch and in Structured Streaming."""
