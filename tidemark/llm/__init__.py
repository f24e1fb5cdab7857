"""Operators of a training-data pipeline: license scans, deduplication, classifiers, packing, archives."""
