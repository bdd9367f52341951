"""Relational operators: blocking, features, metrics, profiling, matching."""
