"""Structured Streaming entry points (the batch ingest, run incrementally)."""
