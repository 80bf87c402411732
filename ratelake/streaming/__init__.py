"""Structured Streaming forms of normalise, delta and insert-if-absent."""
