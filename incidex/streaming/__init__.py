"""Incremental (Structured Streaming) form of the landing -> bronze step."""
