"""Column expressions: geometry, catalogue vocabulary, text parsing."""
