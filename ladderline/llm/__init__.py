"""Operators for building training corpora, and their queries."""
