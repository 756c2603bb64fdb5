"""Operators for preparing training text: filters, classifiers, near-duplicates, packing, mixing, search."""
