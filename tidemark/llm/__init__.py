"""Operators for preparing training text: counting, extracting, deduplicating, mixing, packing."""
