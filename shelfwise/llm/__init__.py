"""Operators for training-data pipelines: cleaning, scoring, deduplication, packing."""
