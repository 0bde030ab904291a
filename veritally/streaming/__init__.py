"""Incremental scoring with Structured Streaming."""
