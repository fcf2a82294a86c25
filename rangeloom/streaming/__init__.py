"""Structured Streaming loads with reorganisation handling."""
