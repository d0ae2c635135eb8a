"""Operators for preparing large text corpora (deduplication, filters, mixing, tokens)."""
