"""Structured Streaming ingest and stream upserts."""
