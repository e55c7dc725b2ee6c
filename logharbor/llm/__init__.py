"""Operators for training-data pipelines: tokenising, deduplication, filtering and extraction over text tables."""
