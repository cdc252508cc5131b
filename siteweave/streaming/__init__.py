"""Structured Streaming over snapshot feeds."""
