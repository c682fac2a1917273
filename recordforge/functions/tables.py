"""Markdown tables as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip, text


def table_lines(md: Column) -> Column:
    return F.filter(F.transform(F.split(text(md), "\n"), strip), lambda x: x != "")


def table_key(md: Column) -> Column:
    """Content without white space, lower case: equal tables have equal keys."""
    return F.regexp_replace(F.lower(text(md)), r"\s+", "")


def separator(line: Column) -> Column:
    return line.rlike(r"^\|?[\s:|-]*---[\s:|-]*$")


def table_rows(md: Column) -> Column:
    """Rows without separators, cells trimmed, white space collapsed, lower case."""
    cell = lambda c: F.regexp_replace(strip(F.lower(c)), r"\s+", " ")
    row = lambda x: F.array_join(F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"\|"), cell), "|")
    return F.transform(F.filter(table_lines(md), lambda x: ~separator(x)), row)


def body_rows(md: Column) -> Column:
    """Pipe lines without separators, less the header."""
    return F.size(F.filter(F.split(text(md), "\n"), lambda x: x.contains("|") & ~x.contains("---"))) - 1


def header_key(md: Column) -> Column:
    return F.coalesce(F.get(table_rows(md), F.lit(0)), F.lit(""))


def table_error(md: Column) -> Column:
    """Why an edited table is refused, or null: too few lines, no separator, uneven columns."""
    rows = table_lines(md)
    cells = F.transform(rows, lambda x: F.size(F.split(x, r"(?<!\\)\|")))
    return (
        F.when(F.size(rows) < 2, "too few lines")
        .when(~separator(F.get(rows, F.lit(1))), "no separator")
        .when(F.size(F.array_distinct(cells)) > 1, "uneven columns")
    )


def is_answer_key(md: Column, kind: Column) -> Column:
    return F.lower(text(kind)).contains("answer") & text(md).contains("Correct Option")


def dedupe(tables: Column) -> Column:
    """Tables (markdown) without exact and proper prefix copies: the longest stays, in the order of input."""
    rows = lambda t: F.array_join(table_rows(t), "\n")
    held = F.transform(tables, lambda t, i: F.struct(t.alias("t"), rows(t).alias("r"), i.alias("i")))

    def covered(x: Column) -> Column:
        longer = lambda y: y["r"].startswith(F.concat(x["r"], F.lit("\n"))) | ((y["r"] == x["r"]) & (y["i"] < x["i"]))
        return F.exists(held, longer)

    return F.transform(F.filter(held, lambda x: ~covered(x)), lambda x: x["t"])


def split_inline(c: Column, least: int = 3) -> Column:
    """(prose, tables): runs of at least ``least`` pipe lines leave the prose and become tables."""
    all_lines = F.split(text(c), "\n")
    piped = lambda x: x.rlike(r"^\s*\|.*\|\s*$")
    zero = F.struct(F.array().cast("array<string>").alias("prose"), F.array().cast("array<string>").alias("tables"), F.array().cast("array<string>").alias("run"))

    def close(acc: Column) -> tuple[Column, Column]:
        enough = F.size(acc["run"]) >= least
        prose = F.when(enough, acc["prose"]).otherwise(F.concat(acc["prose"], acc["run"]))
        tables = F.when(enough, F.array_append(acc["tables"], F.array_join(acc["run"], "\n"))).otherwise(acc["tables"])
        return prose, tables

    def step(acc: Column, x: Column) -> Column:
        prose, tables = close(acc)
        on = piped(x)
        return F.struct(
            F.when(on, acc["prose"]).otherwise(F.array_append(prose, x)).alias("prose"),
            F.when(on, acc["tables"]).otherwise(tables).alias("tables"),
            F.when(on, F.array_append(acc["run"], x)).otherwise(F.array().cast("array<string>")).alias("run"),
        )

    def end(acc: Column) -> Column:
        prose, tables = close(acc)
        return F.struct(F.array_join(prose, "\n").alias("prose"), tables.alias("tables"))

    return F.aggregate(all_lines, zero, step, end)
