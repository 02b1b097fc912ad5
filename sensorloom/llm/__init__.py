"""Operators of a training-data pipeline: mixing, near duplicates, archives, extraction, filters, token files."""
