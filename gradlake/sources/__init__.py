"""Readers and writers of examples, weights and run records."""
