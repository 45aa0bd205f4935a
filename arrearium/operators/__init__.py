"""Relational operators: folds, slices, as-of lookups, joins, windows."""
