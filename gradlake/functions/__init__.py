"""Column expressions: vector algebra, seeded randomness, half precision and run-file names."""
