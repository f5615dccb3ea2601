"""Operators for training-data corpora: duplicates, extraction, scoring, filters and token files."""
