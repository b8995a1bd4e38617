"""Operators for preparing text corpora: filters, duplicates, privacy, tokens, packing."""
