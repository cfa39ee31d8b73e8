"""Registry of named queries and their independent SQL oracles.

Each query is a function ``(spark, sf_dir) -> DataFrame`` built from the
operators package.  The oracle, when one exists, is plain SQL over the same
tables that DuckDB can run; its column names match the query's.

Rounded doubles that can be near zero get ``+ 0.0`` in the oracle: DuckDB's
``round`` keeps the sign of a negative zero, Spark's (decimal based) never
produces one, and a value hash would tell them apart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
NOTES: dict[str, str] = {}


def query(name: str, sql: str | None = None, note: str | None = None):
    """Register ``fn`` under ``name``; ``sql`` is its oracle (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        if note:
            NOTES[name] = note
        return fn

    return deco
