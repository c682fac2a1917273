"""Registry of the record engine's queries and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Small stated cases of operators whose query is bound to the tables: run by the tests only.
CASES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {}
FLAGSHIP = "evidence_overlap"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its DuckDB twin. One that was there before becomes a case."""

    def put(fn):
        if name in QUERIES and name in ORACLES:
            CASES[name] = QUERIES[name], ORACLES.pop(name)
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return put
