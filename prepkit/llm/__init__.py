"""Operators for text corpora before training: filters, deduplication, mixing, packing, sharding, search."""
