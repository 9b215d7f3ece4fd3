"""Operators for preparing training text: fixity, deduplication, tokens, search, filters, packing, extraction."""
