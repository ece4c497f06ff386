"""Structured Streaming forms of the landing diff and the first-seen filter."""
