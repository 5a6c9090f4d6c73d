"""Column expressions: geometry, decoding, quality rules and weights."""
