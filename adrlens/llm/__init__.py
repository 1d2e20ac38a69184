"""Operators for training-data pipelines: search, token files, filters, near duplicates, packing."""
