"""Operators on tables of examples, orders, weights and run records."""
