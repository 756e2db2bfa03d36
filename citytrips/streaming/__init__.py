"""Structured Streaming forms of the raw merge and the hourly counts."""
