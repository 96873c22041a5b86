"""Queries over the given tables, and the SQL each of them must agree with."""
