"""Structured Streaming ingest: raw log -> foreachBatch -> stored tables."""
