"""Operators for text corpora: cleaning, deduplication, scoring and token output."""
