"""Operators for preparing training text: sharding, filtering, scoring, deduplication, search, archives, tokens, packing."""
