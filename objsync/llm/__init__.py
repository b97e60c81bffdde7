"""Operators for building training corpora at scale, and their queries."""
