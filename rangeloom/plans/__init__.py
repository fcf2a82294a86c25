"""Queries over the given tables, each with the SQL that must agree."""
