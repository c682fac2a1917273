"""Document fingerprints: a canonical exact digest.

Native: DataFrame functions only.

A text is brought to NFKC with full case folding (ICU, which ships with Spark; ASCII texts
need only ``lower``) and every run of white space becomes one space. Two chained xxhash64
digests of the result make a fingerprint of 128 bits. Groups of equal fingerprints are
compared byte by byte, so a collision never merges two texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Seeds the second half of a fingerprint.
SALT = "recordforge-fingerprint"
#: Ranges of ids that a pass in id order is cut into: so many for each shuffle partition, looked up in two steps.
RANGES_PER_PARTITION, MAX_RANGES = 6, 1 << 16

#: A class of more than this fraction of all rows is met by a broadcast of its one row.
HOT = 1000

_LEAST = -(1 << 63)


def canonical(text: Column) -> Column:
    """NFKC, case folded, white space folded and trimmed; null becomes the empty text."""
    text = F.coalesce(text, F.lit(""))
    icu = "com.ibm.icu"

    def nfkc(c: Column) -> Column:
        return F.reflect(F.lit(f"{icu}.text.Normalizer"), F.lit("compose"), c, F.lit(True))

    folded = nfkc(F.reflect(F.lit(f"{icu}.lang.UCharacter"), F.lit("foldCase"), nfkc(text), F.lit(True)))
    plain = F.char_length(text) == F.octet_length(text)
    return F.trim(F.regexp_replace(F.when(plain, F.lower(text)).otherwise(folded), r"[\s\p{Z}\x85\x1c-\x1f]+", " "))


def fingerprint(canon: Column) -> Column:
    """32 hex digits of a canonical text: two xxhash64, the second one seeded by a salt."""
    return F.concat(*[F.lpad(F.lower(F.hex(h)), 16, "0") for h in (F.xxhash64(canon), F.xxhash64(F.lit(SALT), canon))])


def exact_groups(docs: DataFrame) -> DataFrame:
    """Exact duplicates of ``docs (doc_id, text)``: doc_id, fingerprint, class_id, class_size; a row for each row.

    class_id is the smallest doc_id with the same canonical bytes, class_size the number of such rows. Rows are
    grouped by fingerprint and bytes with partial sums, so a task sends one row of a text however many copies it has. Ids
    then meet their class by fingerprint: classes of more than a HOT-th of all rows, fewer than HOT of them, are broadcast, so no
    copies gather in one task. Only where texts differ in spite of equal digests do ids meet classes by bytes.
    Null texts count as empty ones; a null doc_id names a class only where it has no other; repeated rows are
    members like others; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select("doc_id", canonical(F.col("text")).alias("canon")).withColumn("fingerprint", fingerprint(F.col("canon")))
    small = common.written(rows.select("doc_id", "fingerprint"), "fp-rows")
    out = ["doc_id", "fingerprint", "class_id", "class_size"]
    texts = rows.groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    buckets = texts.groupBy("fingerprint").agg(F.min("class_id").alias("class_id"), F.sum("class_size").alias("class_size"), F.count("*").alias("n_texts"))
    buckets = common.written(buckets, "fp-buckets")
    total, clashes = buckets.agg(F.sum("class_size"), F.count_if(F.col("n_texts") > 1)).first()
    hot = F.broadcast(buckets.where(F.col("class_size") * F.lit(HOT) > F.lit(total or 0)))
    cold = buckets.where(F.col("class_size") * F.lit(HOT) <= F.lit(total or 0))
    named = small.join(hot, "fingerprint").unionByName(small.join(hot, "fingerprint", "left_anti").join(cold, "fingerprint"))
    if not clashes:
        return named.select(*out)
    apart = rows.join(buckets.where("n_texts > 1").select("fingerprint"), "fingerprint").join(texts, ["fingerprint", "canon"])
    return named.where("n_texts = 1").select(*out).unionByName(apart.select(*out))


def _place(cuts: list[int], k: Column) -> Column:
    """How many of the sorted ``cuts`` are at most k: first among every so-many-th of them, then among those between."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    below = lambda xs: F.size(F.filter(xs, lambda c: c <= k))
    coarse = below(F.array(*map(F.lit, cuts[::step])))
    fine = F.array(*[F.array(*map(F.lit, cuts[i + 1 : i + step])).cast("array<bigint>") for i in range(0, len(cuts), step)])
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + 1 + below(F.get(fine, coarse - 1)))


def with_next(rows: DataFrame, key: str, ties: list[str], take: list[str]) -> DataFrame:
    """Each row with ``next_<c>`` for c in ``take``: of the row after it by descending ``key``, cyclic.

    Not one global sort: the keys' quantiles cut them into ranges, each range is one window
    partition, and the row that follows a range (the head of the range below, or of the
    topmost) is copied into it. Heads are one number a range, at most MAX_RANGES. Null keys come last.
    Equal keys follow each other in the order of ``ties``; rows that agree in those too may change places. The only row of
    a table follows itself; an empty table gives no rows. ``rows`` must not have columns named _k, _at, _p, _copy.
    """
    spark = rows.sparkSession
    n = min(MAX_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    k = F.coalesce(F.col(key), F.lit(_LEAST)).cast("long")
    cuts = rows.select(F.percentile_approx(k, [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    cuts = sorted(set(cuts))
    at = _place(cuts, k)
    heads = rows.groupBy(at.alias("b")).agg(F.max(k).alias("head")).orderBy(F.col("b").desc()).collect()
    rows = rows.withColumn("_k", k).withColumn("_at", at)
    if heads:
        into = {below.head: above.b for above, below in zip(heads, heads[1:])} | {heads[0].head: heads[-1].b}
        lookup = F.map_from_arrays(F.array(*map(F.lit, into)), F.array(*map(F.lit, into.values())))
        extra = F.when(F.col("_k").isin(*into), F.element_at(lookup, F.col("_k")))
        places = F.array_compact(F.array(F.struct(F.col("_at").alias("at"), F.lit(0).alias("copy")), F.when(extra.isNotNull(), F.struct(extra.alias("at"), F.lit(1).alias("copy")))))
        rows = rows.withColumn("_p", F.explode(places)).withColumn("_at", F.col("_p.at")).withColumn("_copy", F.col("_p.copy")).drop("_p")
    else:
        rows = rows.withColumn("_copy", F.lit(0))
    w = Window.partitionBy("_at").orderBy("_copy", F.col("_k").desc(), *ties)
    rows = rows.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in take])
    return rows.where("_copy = 0").drop("_k", "_at", "_copy")


def likeness(fp_a: Column, fp_b: Column, text_a: Column, text_b: Column) -> Column:
    """1.0 where two fingerprints are equal and their canonical bytes too, else 0.0: the digest is exact."""
    return F.when((fp_a == fp_b) & (canonical(text_a) == canonical(text_b)), F.lit(1.0)).otherwise(F.lit(0.0))


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their half-edited texts, and the class of exact copies each belongs to.

    A null text is an empty one. Of repeated rows each has its row; copies of one id share a class; an empty table gives none.
    """
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    classes = exact_groups(docs).groupBy("doc_id", "fingerprint").agg(F.min("class_id").alias("class_id"), F.max("class_size").alias("class_size"))
    classes = classes.withColumnsRenamed({"doc_id": "id2", "fingerprint": "fingerprint2"})
    docs = docs.withColumn("fingerprint", fingerprint(canonical(F.col("text")))).withColumn("_h", F.xxhash64("text"))
    both = with_next(docs, "doc_id", ["_h", "text"], ["text", "fingerprint"])
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    both = both.withColumn("n_chars", n.cast("long")).withColumn("edited", edited)
    both = both.withColumn("edited_fingerprint", fingerprint(canonical(F.col("edited"))))
    both = both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), F.col("text"), F.col("edited")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), F.col("text"), F.col("next_text")).alias("near_next"),
    )
    named = F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("fingerprint") == F.col("fingerprint2"))
    return both.join(classes, named).drop("id2", "fingerprint2")
