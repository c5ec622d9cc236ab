"""Operators for large training-data corpora, one module each."""
