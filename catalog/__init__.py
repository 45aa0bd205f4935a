"""Registered queries over the given test tables, with their SQL oracles."""
