"""Streams: append-only ledgers to current state, late fragments, carried blocks, quota, exactly-once replacement."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def current_state(events: DataFrame, key: str, position: list[str], columns: list[str]) -> DataFrame:
    """Last event of each key; works on a stream (complete or update mode) and on a table alike."""
    return events.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*position)).alias("_last")).select(key, "_last.*")


def windowed_counts(events: DataFrame, ts: str = "ts", late: str = "10 minutes", size: str = "1 hour", *by: str) -> DataFrame:
    """Event-time counts with a watermark: rows later than ``late`` no longer change a closed window."""
    g = events.withWatermark(ts, late).groupBy(F.window(ts, size), *by).count()
    return g.select(F.col("window.start").alias("start"), *by, F.col("count").alias("n"))


def daily_calls(calls: DataFrame, zone: str = "America/Los_Angeles", cap: int = 480) -> DataFrame:
    """Calls by key and day of a zone, and whether the day's budget is spent."""
    day = F.date_format(F.from_utc_timestamp("ts", zone), "yyyy-MM-dd")
    return calls.groupBy("key", day.alias("day")).agg(F.count("*").alias("calls")).withColumn("spent", F.col("calls") >= cap)


def carried_blocks(turns: DataFrame, key: str = "conv_id", order: str = "turn", expire: str | None = None) -> DataFrame:
    """``turns (key, order, text)``: each turn with the last open block before it, kept as state across batches.

    A block is open while its text does not end a sentence. With ``expire`` the state of a silent key goes after that
    (processing) time; such a query wakes up to check, so it suits running streams, not one pass over files.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        carry = state.get[0] if state.exists else None
        out = []
        for b in batches:
            for at, text in sorted(zip(b[order].tolist(), b["text"].fillna("").tolist())):
                out.append((k[0], at, carry))
                if not text.rstrip().endswith((".", "!", "?")):
                    carry = at
        if carry is not None:
            state.update((carry,))
        if expire:
            state.setTimeoutDuration(int(pd.Timedelta(expire).total_seconds() * 1000))
        yield pd.DataFrame(out, columns=[key, order, "carried"]).astype({"carried": "Int64"})

    schema = f"{key} long, {order} long, carried long"
    kind = GroupStateTimeout.ProcessingTimeTimeout if expire else GroupStateTimeout.NoTimeout
    return turns.groupBy(key).applyInPandasWithState(step, schema, "carry long", "append", kind)


def late_fragments(fragments: DataFrame, owners: DataFrame, key: str = "frag_key", wait: str = "1 hour") -> DataFrame:
    """Stream-stream join: fragments meet an owner that arrives within ``wait``; those that never do come out with a null owner.

    fragments: key, ts; owners: key, owner, owner_ts.
    """
    f = fragments.withWatermark("ts", wait).alias("f")
    o = owners.withWatermark("owner_ts", wait).withColumnRenamed(key, "_k").alias("o")
    near = F.expr(f"{key} = _k AND owner_ts >= ts - INTERVAL {wait} AND owner_ts <= ts + INTERVAL {wait}")
    return f.join(o, near, "left_outer").drop("_k")


def replace_chapters(rows: DataFrame, path: str, checkpoint: str, *by: str) -> StreamingQuery:
    """Each micro-batch replaces its chapters' partitions; replaying a batch gives the same files."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_files(spark: SparkSession, path: str, schema, per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(path)
