"""Whole digests and the query catalogue."""
