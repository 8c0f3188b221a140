"""Operators for preparing training corpora: filters, language, deduplication, tokens, search, packing."""
