"""Structured Streaming: ingestion, exactly-once merges, event-time windows."""
