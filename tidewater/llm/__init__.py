"""Operators for preparing training text: dedup, filters, scores, mixing, tokens."""
