"""Structured Streaming path for live sensor readings."""
