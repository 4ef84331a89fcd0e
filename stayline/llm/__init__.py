"""Operators for training-data pipelines: filters, deduplication, tokens and formats."""
