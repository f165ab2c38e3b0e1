"""Structured Streaming: incremental ingest and SCD-1 upsert targets."""
