"""Operators for large training-data corpora, and the queries that apply them to the given tables."""
