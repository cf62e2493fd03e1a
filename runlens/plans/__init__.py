"""Staged tables and the query bindings over the given tables."""
