"""Structured Streaming jobs (T-01..T-13)."""
