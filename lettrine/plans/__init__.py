"""Queries of the engine over the given tables, and the SQL that they are held against."""

from __future__ import annotations

from . import checks, fields, geometry, measures, readings, reports
from .checks import review_by_bank

_PAIRS = {**readings.PAIRS, **fields.PAIRS, **geometry.PAIRS, **checks.PAIRS, **reports.PAIRS, **measures.PAIRS}
QUERIES = {f.__name__: f for f in _PAIRS}
ORACLE_SQL = {f.__name__: sql for f, sql in _PAIRS.items() if sql}

__all__ = ["ORACLE_SQL", "QUERIES", "review_by_bank"]
