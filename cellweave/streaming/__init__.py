"""Continuous ingestion and change feed with Structured Streaming."""
