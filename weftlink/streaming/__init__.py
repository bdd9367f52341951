"""Incremental inference with Structured Streaming."""
