"""Operators for preparing training data: deduplication, tokens, archives, packing, sharding, filters, search.

Nothing else in the library imports this package.
"""
