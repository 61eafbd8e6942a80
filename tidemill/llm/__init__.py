"""Operators for preparing training data: filters, deduplication, archives, mixing, search and packing."""
