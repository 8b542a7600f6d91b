"""Structured Streaming jobs built on the batch plans."""
