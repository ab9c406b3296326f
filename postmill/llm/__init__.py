"""Operators for preparing training text: filters, scores, deduplication and encoding."""
