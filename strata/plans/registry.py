"""Registry of the test queries (``queries()``) and their DuckDB oracles (``oracle_sql()``)."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with an optional oracle."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco
