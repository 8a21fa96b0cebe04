"""Chunk streams on Structured Streaming."""
