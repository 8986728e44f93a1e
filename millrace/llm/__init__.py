"""Operators for preparing training text: scoring, cleaning, deduplication, search and mixing."""
