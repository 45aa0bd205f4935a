"""Imports every query module so that the registry is complete."""

from catalog import cleaning, entities, folds, joins, kpis, readers, sources, streams  # noqa: F401
from catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
