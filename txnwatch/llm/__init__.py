"""Operators of a training-data pipeline: classifiers, search, token files, packing, extraction, deduplication."""
