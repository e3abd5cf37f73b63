"""Structured Streaming jobs (foreachBatch ingest and search)."""
