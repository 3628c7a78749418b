"""Operators for preparing training corpora: URL filters, mixing, packing, near-duplicates, search, sharding."""
