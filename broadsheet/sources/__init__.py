"""Landed payloads and reference lists as DataFrames."""
