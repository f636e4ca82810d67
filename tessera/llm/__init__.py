"""Operators for large training-data pipelines: dedup, mixing, archives, filters, packing."""
