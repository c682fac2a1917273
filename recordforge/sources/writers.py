"""Sinks: atomic, keyed, partitioned and gated writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordforge.operators.records import first_rows, last_by


def unique_first(rows: DataFrame, path: str, key: str, *order: str) -> None:
    """Rewrite with the first row of each key; rows without one are dropped."""
    first_rows(rows, key, *order).write.mode("overwrite").json(path)


def unique_last(rows: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each key."""
    return last_by(rows, key, F.col(position), *[c for c in rows.columns if c != key])


def replace_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Replace exactly the partitions that ``rows`` has; others stay. Writing the same rows again changes nothing."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(rows: DataFrame, path: str) -> None:
    """Add to a ledger."""
    rows.write.mode("append").json(path)


def split(tables: dict[str, DataFrame], root: str, *by: str, last: str = "completeness") -> None:
    """Write the tables of a split partitioned; the roll-up comes last and so marks the rest as whole."""
    for name in [*(n for n in tables if n != last), *(n for n in tables if n == last)]:
        replace_partitions(tables[name], f"{root}/{name}", *by)


def final(tables: dict[str, DataFrame], open_flags: DataFrame, root: str) -> dict[str, int]:
    """Write the export and return its receipt (rows by table); refused while any flag is open."""
    if not open_flags.isEmpty():
        raise PermissionError("the final export is locked: flags are open")
    receipt = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        receipt[name] = df.sparkSession.read.parquet(f"{root}/{name}").count()
    return receipt


def inventory(expected: DataFrame, present: DataFrame, key: str = "path") -> DataFrame:
    """Expected files with whether they were found and their size."""
    return expected.join(present.select(key, "length"), key, "left").withColumn("outcome", F.when(F.col("length").isNull(), "missing").otherwise("copied"))


def digest(flags: DataFrame) -> DataFrame:
    """A markdown text for each subject: tiers in order with their entries."""
    tier = F.when(F.col("tier") == "BLOCKER", 0).when(F.col("tier") == "REVIEW", 1).otherwise(2)
    line = F.concat(F.lit("- ["), "tier", F.lit("] "), "q_id", F.lit(": "), "detail")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(tier.alias("t"), "q_id", line.alias("line")))), lambda x: x["line"]), "\n")
    return flags.groupBy("subject").agg(F.concat(F.lit("# "), F.first("subject"), F.lit("\n"), body).alias("markdown"))
