"""Structured Streaming jobs over both feeds."""
