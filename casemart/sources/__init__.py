"""Readers, the raw-file catalogue, the raw contract and landing checks."""
