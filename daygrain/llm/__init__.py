"""Operators of a training-data pipeline: deduplication, counting, packing, filtering, extraction."""
