"""Operators for large-scale text corpora. Nothing outside this package imports it."""
