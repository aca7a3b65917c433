"""Operators for preparing training data: quality, search, dedupe, tokens, archives."""
