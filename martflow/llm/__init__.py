"""Operators for training-data pipelines: quality, deduplication, search, mixing and tokens."""
