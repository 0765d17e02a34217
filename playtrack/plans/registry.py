"""Query registry: each entry is a Spark function ``(spark, sf_dir) -> DataFrame``
and, where the result is SQL-expressible, the equivalent DuckDB SQL.

Oracle SQL is written once per query next to its Spark code; the staging views
are prefixed by ``with_staging``.
"""

from __future__ import annotations

from collections.abc import Callable

from .staging_sql import with_staging

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register a query (and its oracle SQL body, if it has one)."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_staging(sql, ctes)
        return fn
    return deco
