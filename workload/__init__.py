"""Queries that run the library over the given tables, and the SQL that says what they must return."""
