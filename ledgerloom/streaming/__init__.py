"""Structured Streaming jobs over the event feed."""
