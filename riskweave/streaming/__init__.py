"""Structured Streaming ingest of the event stream."""
