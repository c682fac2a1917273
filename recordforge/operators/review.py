"""Review: union of flag sources, keys, decisions, cards, gate, digest, quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.functions import patterns as P


def queue(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of flag sources (kind, q_id, chapter, detail and anything else): with source, severity and flag_key.

    The key tells sources apart. The catch-all source ``validator`` adds only flags whose key is not there yet, each once.
    """
    parts = [df.select("kind", "q_id", "chapter", F.substring(F.coalesce("detail", F.lit("")), 1, P.DETAIL_LEN).alias("detail"), F.lit(name).alias("source")) for name, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    blocker = F.col("kind").isin(*P.BLOCKER_KINDS)
    out = out.withColumn("severity", F.when(blocker, "BLOCKER").otherwise("REVIEW"))
    out = out.withColumn("flag_key", K.flag_key(F.col("kind"), F.col("q_id"), F.col("chapter"), F.col("source"), F.col("detail")))
    named, rest = out.where("source <> 'validator'"), out.where("source = 'validator'")
    rest = rest.join(named.select("flag_key").distinct(), "flag_key", "left_anti")
    columns = out.columns
    rest = rest.groupBy("flag_key").agg(F.min(F.struct(*columns)).alias("f")).select("f.*")  # one key, one flag
    return named.unionByName(rest.select(*columns))


def latest(decisions: DataFrame, key: str = "flag_key", position: str = "pos") -> DataFrame:
    """The last decision of each key."""
    return decisions.groupBy(key).agg(F.max_by(F.struct("action", "content_sig"), F.col(position)).alias("d")).select(key, "d.action", "d.content_sig")


def overlay(flags: DataFrame, decisions: DataFrame) -> DataFrame:
    """Flags with state: open without a decision or when reopened, stale when the content changed since, else closed."""
    j = flags.join(latest(decisions).withColumnRenamed("content_sig", "decided_sig"), "flag_key", "left")
    state = (
        F.when(F.col("action").isNull() | (F.col("action") == "reopened"), "open")
        .when(F.col("decided_sig") != F.col("content_sig"), "stale")
        .otherwise("closed")
    )
    return j.withColumn("state", state)


def cards(flags: DataFrame) -> DataFrame:
    """One card an entity: q_id, else chapter, kind and the start of the detail; worst severity, kinds, flags."""
    entity = F.coalesce("q_id", F.concat_ws("|", F.coalesce("chapter", F.lit("")), "kind", F.substring("detail", 1, 80)))
    rank = F.when(F.col("severity") == "BLOCKER", 0).otherwise(1)
    g = flags.groupBy(entity.alias("entity")).agg(F.min(rank).alias("r"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"), F.count("*").alias("flags"))
    return g.select("entity", F.when(F.col("r") == 0, "BLOCKER").otherwise("REVIEW").alias("severity"), "kinds", "flags")


def gate(flags: DataFrame) -> DataFrame:
    """One row: open, blockers, locked."""
    is_open = F.col("state") != "closed"
    return flags.agg(F.count_if(is_open).alias("open"), F.count_if(is_open & (F.col("severity") == "BLOCKER")).alias("blockers")).withColumn("locked", F.col("open") > 0)


def watchdog(files: DataFrame, name: str = "name") -> DataFrame:
    """Files that no registry knows: each is a blocker."""
    known = [*P.FLAG_FILES, *P.CORE_FILES]
    return files.where(~F.col(name).isin(known)).select(F.col(name), F.lit("watchdog_unregistered_file").alias("kind"), F.lit("BLOCKER").alias("severity"))


def verification(genuine: Column, confidence: Column, parsed: Column, key: Column) -> Column:
    """Outcome of a second opinion: closed only if parsed, sure and not genuine, and not sampled back."""
    ok = parsed & (confidence == "high") & ~genuine
    return F.when(ok & K.sampled(key), "sampled_back").when(ok, "closed").otherwise("open")


def replay_quota(calls: DataFrame, cap: int = P.DAILY_CAP, cooldown: int = P.COOLDOWN_SECONDS) -> DataFrame:
    """``calls (key, ts, id, burst)``: the running count of a key and day, whether it is over the cap or inside a cooldown.

    A burst error blocks its key for the cooldown: a range frame over seconds finds one just before.
    """
    day = K.day_stamp(F.col("ts"))
    calls = calls.withColumn("day", day).withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp")))
    run = Window.partitionBy("key", "day").orderBy("ts", "id")
    near = Window.partitionBy("key").orderBy("micros").rangeBetween(-cooldown * 1_000_000, -1)
    return (
        calls.withColumn("used", F.row_number().over(run))
        .withColumn("over_cap", F.col("used") > cap)
        .withColumn("cooling", F.coalesce(F.max(F.col("burst").cast("int")).over(near), F.lit(0)) == 1)
        .drop("micros")
    )


def carry(turns: DataFrame, by: str, at: str, opened: Column) -> DataFrame:
    """Rows with the last open block before them: ``carried``, null where none is."""
    w = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    return turns.withColumn("carried", F.last(F.when(opened, F.col(at)), ignorenulls=True).over(w))
