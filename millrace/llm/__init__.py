"""Operators of a training-data pipeline: filtering, cleaning, deduplication, packing."""
