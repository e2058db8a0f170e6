"""Operators for large text corpora: deduplication, packing, filtering, search, tokenizing."""
