"""Continuous digest on Structured Streaming."""
