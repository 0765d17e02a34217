"""Registered queries (``queries()``) and their DuckDB oracle SQL (``oracle_sql()``)."""

from __future__ import annotations

from . import q_features, q_injury, q_io, q_ml, q_plays, q_tracking  # noqa: F401  (register queries)
from .registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
