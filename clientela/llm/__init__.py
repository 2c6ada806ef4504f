"""Operators for training text: deduplication, filtering, scoring and tokenizing at corpus scale."""
