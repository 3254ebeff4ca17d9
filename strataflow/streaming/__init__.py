"""Incremental ingest and upserts with Structured Streaming."""
