"""Incremental ingest of landed pages with Structured Streaming."""
