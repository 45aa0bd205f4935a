"""Operators for preparing training text: deduplication, filtering, scoring, tokens, archives and shards."""
