"""Operators for building training corpora, with their queries."""
