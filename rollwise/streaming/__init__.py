"""Structured Streaming continuous load."""
