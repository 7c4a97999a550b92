"""Operators on text corpora: dedup, personal data, secrets, packing, mixing, quality."""
