"""Structured Streaming twins of the ingest jobs."""
