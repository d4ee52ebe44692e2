"""Incremental archiving with Structured Streaming."""
