"""Mixing sources to target weights: a low-discrepancy schedule over equal-token blocks.

Native: DataFrame functions only.

Every source's documents are put in a reproducible random order (by an MD5 of the id) and
read as one endless stream, begun anew when it ends. The stream is cut into blocks of the
same number of words. Slots of the mix are laid out by the golden-ratio sequence: point
``frac(i * phi)`` falls into one source's share of the cumulative targets. The n-th slot of a
source takes the n-th block of its stream.

Hot sources are no special case: offsets come from sums over hash buckets of a source plus
sums inside a bucket, ranks of slots from sums over chunks of slots plus ranks inside a
chunk; blocks and slots meet on the unique key (source, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Fractional part of the golden ratio: the step of the low-discrepancy sequence.
PHI = 0.6180339887498949
#: Weights by the source's place in code-point order, repeated.
WEIGHTS = (3, 1, 2)
#: Slots to aim at; a block is never shorter than MIN_BLOCK words.
MAX_SLOTS = 1 << 20
MIN_BLOCK = 16
CHUNK = 4096
#: Cells of the line on which points meet the sources' shares.
CELLS = 4096


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share_num: int = 3, share_den: int = 2, cap: int = 2) -> DataFrame:
    """Water-filled targets by source. ``sizes``: source, size (one row a document).

    The total ``share_num / share_den`` of all sizes is shared by weight; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight, until none is above.
    In the order of cap / weight the sources that stop are a prefix, so running sums find them
    in one pass; all is whole numbers until the last division. A null source counts as one
    more source after all others. Returns source, si (place), source_size, target (double).
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.array(*map(F.lit, weights))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("si", F.row_number().over(place) - 1)
    s = s.withColumn("w", F.get(w, F.pmod("si", F.lit(len(weights)))).cast("long")).withColumn("top", F.lit(cap) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("top") / F.col("w"), "si")
    every = Window.partitionBy()
    s = (
        s.withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("before", F.coalesce(F.sum("top").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    )
    full = F.lit(share_den) * F.col("top") * F.col("w_left") <= (F.lit(share_num) * F.col("all_size") - F.lit(share_den) * F.col("before")) * F.col("w")
    s = s.withColumn("stops", full)
    s = s.withColumn("stopped", F.coalesce(F.sum(F.when(F.col("stops"), F.col("top"))).over(every), F.lit(0))).withColumn(
        "w_open", F.sum(F.when(~F.col("stops"), F.col("w"))).over(every)
    )
    shared = (F.col("w") * (F.lit(share_num) * F.col("all_size") - F.lit(share_den) * F.col("stopped"))).cast("double") / (F.lit(share_den) * F.col("w_open")).cast("double")
    return s.select("source", "si", "source_size", F.when(F.col("stops"), F.col("top").cast("double")).otherwise(shared).alias("target"))


def schedule(quota: DataFrame) -> DataFrame:
    """Slots of the mix: slot, si, block. ``quota``: si, want (blocks, at least one) by source.

    Slot i belongs to the source in whose share of the cumulative quotas, in the order of si, the point
    ``frac((i + 1) * PHI)`` falls. Ranks beyond the quota are given up, and the few blocks that the sequence
    has left over take the slots after the last, so that each block of a quota has one slot. Points meet
    shares on the cells of a line, so sources are neither gathered nor held by the driver; only their running
    sum, one row a source, is one task's work. No quota gives no slots.
    """
    n = quota.agg(F.sum("want")).first()[0] or 0
    cells = max(1, min(n, CELLS))
    cell = lambda x: F.least(F.floor(x * F.lit(cells) / F.lit(max(1, n))), F.lit(cells - 1))
    shares = quota.select("si", F.col("want").alias("limit"), F.sum("want").over(Window.orderBy("si").rowsBetween(Window.unboundedPreceding, 0)).alias("end"))
    shares = shares.withColumn("begin", F.col("end") - F.col("limit"))
    shares = shares.withColumn("cell", F.explode(F.sequence(F.greatest(cell(F.col("begin")) - 1, F.lit(0)), F.least(cell(F.col("end")) + 1, F.lit(cells - 1)))))
    point = (F.col("id") + 1) * F.lit(PHI)
    at = F.least((point - F.floor(point)) * F.lit(float(n)), F.lit(n - 0.5))
    slots = quota.sparkSession.range(n).select(F.col("id").alias("slot"), F.floor(F.col("id") / CHUNK).alias("chunk"), at.alias("at"))
    slots = slots.withColumn("cell", cell(F.col("at"))).join(shares, "cell").where("begin <= at and at < end").select("slot", "chunk", "si", "limit")
    slots = common.written(slots, "mix-slots")
    per = slots.groupBy("si", "chunk").agg(F.count("*").alias("n"))
    run = Window.partitionBy("si").orderBy("chunk")
    per = per.withColumn("before", F.sum("n").over(run) - F.col("n"))
    inside = Window.partitionBy("si", "chunk").orderBy("slot")
    ranked = slots.withColumn("r", F.row_number().over(inside) - 1).join(per.drop("n"), ["si", "chunk"])
    ranked = ranked.select("slot", "si", (F.col("before") + F.col("r")).alias("block"), "limit").where("block < limit").drop("limit")
    got = per.groupBy("si").agg(F.sum("n").alias("got"))
    late = quota.join(got, "si", "left").where("want > coalesce(got, 0)")
    late = late.select((F.lit(n) + F.col("si")).alias("slot"), "si", F.explode(F.sequence(F.coalesce("got", F.lit(0)), F.col("want") - 1)).alias("block"))
    return ranked.unionByName(late)


def mix(docs: DataFrame, weights=WEIGHTS, share_num: int = 3, share_den: int = 2, cap: int = 2, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """The mix of ``docs (doc_id, source, text)``: (documents, pieces).

    documents: doc_id, the columns of ``keep``, source, size, source_size, target, taken; one row for each row of the
    input, repeated ids and all, with first_slot, n_slots and slot_sum of the slots that hold words of it. pieces: slot, si, block, doc_id, words: which words count of which document a
    slot of the mix holds. A source's taken words are its target, rounded down. No document gives
    more than ``cap`` times its words. Documents without words (null, empty, blank) take nothing;
    an empty table gives empty results. Neither the
    documents nor the sources are bounded in number.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = docs.select("doc_id", *keep, "source", word_count(F.col("text")).alias("size"))
    sizes = common.written(sizes.withColumn("key", key), "mix-sizes")
    aims = common.written(targets(sizes, weights, share_num, share_den, cap), "mix-targets")
    aims = aims.withColumn("has", F.floor("target"))
    total = aims.agg(F.sum("has")).first()[0] or 0
    block = max(MIN_BLOCK, -(-total // MAX_SLOTS))
    slots = schedule(aims.select("si", F.ceil(F.col("has") / block).alias("want")).where("want > 0"))
    named = sizes.join(aims, sizes.source.eqNullSafe(aims.source)).drop(aims.source).drop("source_size", "target")
    named = named.withColumn("bucket", F.substring("key", 1, 3))
    inside = Window.partitionBy("si", "bucket").orderBy("key", "doc_id", "size", *keep)
    per = named.groupBy("si", "bucket").agg(F.sum("size").alias("n"))
    per = per.withColumn("before", F.sum("n").over(Window.partitionBy("si").orderBy("bucket")) - F.col("n")).drop("n")
    laid = named.withColumn("in_bucket", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    laid = laid.join(per, ["si", "bucket"]).withColumn("start", F.col("before") + F.col("in_bucket"))
    whole = aims.select("si", "source_size", "target")

    laid = laid.join(whole, "si").select("doc_id", *keep, "source", "size", "si", "has", "start", "source_size", "target")
    turns = F.explode(F.sequence(F.lit(0), F.lit(cap - 1)))
    turned = laid.select("*", turns.alias("turn")).withColumn("at", F.col("start") + F.col("turn") * F.col("source_size"))
    turned = turned.withColumn("end", F.least(F.col("at") + F.col("size"), F.col("has")))
    real = F.col("end") > F.col("at")
    blocks = F.when(real, F.sequence(F.floor(F.col("at") / block), F.floor((F.col("end") - 1) / block)))
    # the first turn's row stays even where the mix takes nothing of a document
    turned = turned.where(real | (F.col("turn") == 0)).withColumn("block", F.explode_outer(blocks))
    words = F.least("end", (F.col("block") + 1) * block) - F.greatest("at", F.col("block") * block)
    cut = turned.withColumn("words", words)
    met = cut.join(slots, ["si", "block"], "left")
    by = ["doc_id", *keep, "source", "size", "source_size", "target", "si", "start"]
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("words"))), F.lit(0)).alias("taken")
    # rows without words share a place in the stream, so they are told apart by not being grouped
    held = [F.min("slot").alias("first_slot"), F.count("slot").alias("n_slots"), F.coalesce(F.sum("slot"), F.lit(0)).alias("slot_sum")]
    some = met.where("size > 0").groupBy(*by).agg(taken, *held).drop("si", "start")
    zero = F.lit(0).cast("long")
    none = laid.where("size = 0").drop("si", "has", "start").withColumns({"taken": zero, "first_slot": F.lit(None).cast("long"), "n_slots": zero, "slot_sum": zero})
    pieces = met.where("slot is not null").select("slot", "si", "block", "doc_id", "words")
    return some.unionByName(none), pieces


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix has them: each document as often as its taken words make it, rounded.

    All columns are kept, whatever their names; they must be orderable. Rows with the same id, source and text share what the
    mix takes of them, evenly and then in the order of their other columns, so reruns agree. An empty
    table stays empty; documents without words go.
    """
    # the caller's row is one column, so that no name of its meets one made here
    keyed = docs.select("doc_id", "source", "text", F.xxhash64("text").alias("_h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    taken, _ = mix(keyed, keep=("_h",), **how)
    times = F.when(F.col("taken") > 0, F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")).otherwise(0)
    same = ["doc_id", "source", "_h"]
    named = [F.col(c).alias(f"{c}2") for c in same]
    taken = taken.withColumn("times", times).groupBy(*named).agg(F.sum("times").alias("times"), F.count("*").alias("sharers")).where("times > 0")
    rows = keyed.join(taken, _equal(same, "2")).drop(*[f"{c}2" for c in same])
    alone = rows.where("sharers = 1").select("_row", F.col("times").alias("copies"))
    many = rows.where("sharers > 1").groupBy(*same, "_row").agg(F.count("*").alias("m"), F.max("times").alias("times"))
    every = Window.partitionBy(*same)
    before = F.sum("m").over(every.orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")
    many = many.withColumn("rows", F.sum("m").over(every)).withColumn("before", before)
    extra = F.greatest(F.lit(0), F.least(F.col("m"), F.col("times") % F.col("rows") - F.col("before")))
    many = many.select("_row", (F.col("m") * F.floor(F.col("times") / F.col("rows")) + extra).alias("copies"))
    out = alone.unionByName(many).where("copies > 0")
    return out.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_t")).select("_row.*")


def _equal(columns: list[str], mark: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).eqNullSafe(F.col(c + mark))
    return out


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table mixed with weights 3, 1, 2 to 150 % of its words, and the slots of each document."""
    out, _ = mix(common.table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "first_slot", "n_slots", "slot_sum")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS si
  FROM d GROUP BY source),
w AS (SELECT *, CASE si % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, 2 * source_size AS top FROM s),
o AS (
  SELECT *, (SELECT sum(source_size) FROM w) AS alls,
         coalesce(sum(top) OVER (ORDER BY top / w, si ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(w) OVER (ORDER BY top / w, si ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left
  FROM w),
p AS (SELECT *, 2 * top * w_left <= (3 * alls - 2 * before) * w AS stops FROM o),
t AS (
  SELECT source, si, source_size, CASE WHEN stops THEN CAST(top AS DOUBLE) ELSE
    CAST(w * (3 * alls - 2 * coalesce((SELECT sum(top) FROM p WHERE stops), 0)) AS DOUBLE)
    / CAST(2 * (SELECT sum(w) FROM p WHERE NOT stops) AS DOUBLE) END AS target FROM p),
l AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS has, t.si,
         CAST(sum(d.size) OVER (PARTITION BY t.si ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
z AS (SELECT greatest(16, CAST(ceil(sum(floor(target)) / 1048576.0) AS BIGINT)) AS block FROM t),
q AS (
  SELECT si, want, CAST(sum(want) OVER (ORDER BY si) AS BIGINT) AS upto, CAST(sum(want) OVER () AS BIGINT) AS n
  FROM (SELECT si, CAST(ceil(floor(target) / (SELECT block FROM z)) AS BIGINT) AS want FROM t) WHERE want > 0),
points AS (
  SELECT i AS slot, least(((i + 1) * 0.6180339887498949e0 - floor((i + 1) * 0.6180339887498949e0)) * CAST(n AS DOUBLE), n - 0.5e0) AS pos
  FROM (SELECT max(n) AS n FROM q), LATERAL (SELECT unnest(range(n)) AS i)),
ranked AS (
  SELECT slot, si, want, row_number() OVER (PARTITION BY si ORDER BY slot) - 1 AS block
  FROM points JOIN q ON pos >= upto - want AND pos < upto),
slots AS (
  SELECT slot, si, block FROM ranked WHERE block < want
  UNION ALL
  SELECT n + q.si, q.si, b
  FROM q LEFT JOIN (SELECT si, count(*) AS got FROM ranked GROUP BY si) g ON q.si = g.si,
       LATERAL (SELECT unnest(range(least(coalesce(got, 0), want), want)) AS b)),
turns AS (
  SELECT doc_id, si, size, start, start + turn * source_size AS pos, least(start + turn * source_size + size, has) AS upto, (SELECT block FROM z) AS block
  FROM l, (SELECT unnest([0, 1]) AS turn)),
cut AS (
  SELECT doc_id, si, start, b, least(upto, (b + 1) * block) - greatest(pos, b * block) AS words
  FROM turns, LATERAL (SELECT unnest(range(pos // block, (upto - 1) // block + 1)) AS b) WHERE upto > pos),
held AS (
  SELECT c.doc_id, c.si, c.start, CAST(sum(words) AS BIGINT) AS taken, min(slot) AS first_slot, count(slot) AS n_slots, CAST(sum(slot) AS BIGINT) AS slot_sum
  FROM cut c JOIN slots s ON c.si = s.si AND c.b = s.block GROUP BY ALL)
SELECT l.doc_id, size, source_size, target, coalesce(taken, 0) AS taken, first_slot, coalesce(n_slots, 0) AS n_slots, coalesce(slot_sum, 0) AS slot_sum
FROM l LEFT JOIN held h ON size > 0 AND l.doc_id IS NOT DISTINCT FROM h.doc_id AND l.si = h.si AND l.start = h.start
"""
