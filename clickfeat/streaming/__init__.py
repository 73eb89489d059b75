"""Structured Streaming form of the click counters (same operator, run incrementally)."""
