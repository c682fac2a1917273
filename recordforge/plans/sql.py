"""Building blocks of the SQL twins, and inline tables for both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordforge.functions import patterns as P
from recordforge.functions import text as X


def q(s) -> str:
    """A SQL literal."""
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return str(s).upper()
    if isinstance(s, (int, float)):
        return str(s)
    if isinstance(s, (list, tuple)):
        return "[" + ", ".join(map(q, s)) + "]"
    return "'" + str(s).replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(X._STRIP)}, '', 'g')"


def norm(x: str) -> str:
    return f"regexp_replace({strip(f'lower(coalesce({x}, {q(str())}))')}, {q(X._RUN)}, ' ', 'g')"


def tokens(x: str) -> str:
    return f"regexp_extract_all({norm(x)}, {q(P.WORD)})"


def values(name: str, columns: str, rows: list[tuple], types: dict[str, str] | None = None) -> str:
    """``name(columns) AS (VALUES ...)`` with casts by column."""
    body = ",\n  ".join("(" + ", ".join(map(q, r)) + ")" for r in rows)
    names = [c.strip() for c in columns.split(",")]
    cast = ", ".join(f"CAST({c} AS {types[c]}) AS {c}" if types and c in types else c for c in names)
    return f"{name} AS (SELECT {cast} FROM (VALUES {body}) v({columns}))"


def inline(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """The same rows as a DataFrame."""
    return spark.createDataFrame(rows, schema)


def overlap(a: str, b: str) -> str:
    """Share of the token list a found in b, by multiset."""
    return (
        f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE list_sum(list_transform(list_distinct({a}), lambda t: "
        f"least(len(list_filter({a}, lambda x: x = t)), len(list_filter({b}, lambda x: x = t))))) / CAST(len({a}) AS DOUBLE) END"
    )
