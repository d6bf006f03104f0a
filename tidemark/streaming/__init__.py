"""Structured Streaming forms of landing, deduplication and bar building."""
