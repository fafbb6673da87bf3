"""Queries over the given tables and the SQL their results must equal."""
