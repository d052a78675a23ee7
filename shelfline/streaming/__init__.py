"""Incremental landing ingest with Structured Streaming."""
