"""Structured Streaming jobs over cart events."""
