"""Identifier-graph risk analytics as Spark DataFrame and Structured Streaming jobs."""
