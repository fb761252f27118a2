"""Operators for large-scale text corpora: scoring, language, tokens, duplicates, search, packing."""
