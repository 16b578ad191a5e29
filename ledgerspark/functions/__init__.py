"""Column expressions: parsing, typing, keys, classification."""
