"""Registered queries: the operators applied to events derived from the given tables."""
