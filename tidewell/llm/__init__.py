"""Operators of a training-data pipeline: duplicates, filters, languages, tokens, private data."""
