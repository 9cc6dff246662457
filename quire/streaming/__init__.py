"""Incremental (Structured Streaming) assessment of a folder."""
