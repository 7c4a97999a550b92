"""Column expressions: parsing, routing, envelopes and numbers."""
