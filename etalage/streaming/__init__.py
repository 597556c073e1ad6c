"""Incremental runs of the same operators with Structured Streaming."""
