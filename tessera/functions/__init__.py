"""Column-level building blocks (predicates, geometry, time, text)."""
