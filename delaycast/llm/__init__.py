"""Operators of a training-data pipeline: scans, filters, classifiers, deduplication, tokenizing."""
