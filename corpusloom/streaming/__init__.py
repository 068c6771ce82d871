"""Structured Streaming versions of the incremental steps."""
