"""Structured Streaming forms of the linkage plan."""
