"""Operators for preparing training text: scoring, near-duplicates, repeats, leaks, mixing, search."""
