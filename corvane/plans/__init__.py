"""Composed plans and the registered queries."""

from . import composed, pages, queries, stored, upkeep

QUERIES, ORACLES = queries.QUERIES, queries.ORACLES
__all__ = ["ORACLES", "QUERIES", "composed", "pages", "queries", "stored", "upkeep"]
