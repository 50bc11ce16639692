"""Operators for preparing training data: packing, encoding, filters, deduplication, search."""
