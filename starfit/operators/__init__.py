"""Relational operators: keyed lookups, split, fit, sweep, scoring and reports."""
