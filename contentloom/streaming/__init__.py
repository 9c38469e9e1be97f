"""Structured Streaming forms of the insert-triggered views."""
