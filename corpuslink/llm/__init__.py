"""Operators of a training-data pipeline: deduplication, filters, counts and packing."""
