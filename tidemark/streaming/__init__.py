"""Structured Streaming: change events and streaming ingest."""
