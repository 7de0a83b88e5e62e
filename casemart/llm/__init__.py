"""Operators for preparing training corpora: filters, deduplication, privacy, mixing, packing and search."""
