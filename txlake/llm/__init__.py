"""Operators for preparing training data: packing, extraction, formatting, scans, dedup, classifiers."""
