"""Corpus operators for preparing large text collections (deduplication, filtering, tokenising)."""
