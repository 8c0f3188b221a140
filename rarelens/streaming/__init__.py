"""Structured Streaming jobs: the same operators on unbounded input."""
