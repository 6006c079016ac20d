"""Operators for preparing training data: filters, scans, classifiers, deduplication, mixing."""
