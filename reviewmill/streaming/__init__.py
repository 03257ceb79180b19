"""Structured Streaming jobs over incoming reviews."""
