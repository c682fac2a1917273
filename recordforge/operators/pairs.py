"""Pairs of similar texts: blocked by shared word shingles, scored in vectorised Python where no column can.

Candidates come from an equi-join on the hashes of shared shingles inside a chapter, so AQE can split a hot
shingle; only pairs with enough in common reach the exact score.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions import text as X


def shared_shingles(docs: DataFrame, n: int = P.SEGMENT_N, least: int = P.SEGMENT_MIN_SHINGLES, by: str = "chapter") -> DataFrame:
    """``docs (chapter, id, text)``: pairs a < b of a chapter with at least ``least`` common shingles: chapter, a, b, common."""
    sh = docs.select(by, "id", F.explode(F.transform(X.shingles(F.col("text"), n), lambda s: F.xxhash64(s))).alias("h"))
    left, right = sh.select(by, F.col("id").alias("a"), "h"), sh.select(by, F.col("id").alias("b"), "h")
    pairs = left.join(right, [by, "h"]).where("a < b")
    return pairs.groupBy(by, "a", "b").agg(F.count("*").alias("common")).where(F.col("common") >= least)


def _texts(pairs: DataFrame, docs: DataFrame, column: str) -> DataFrame:
    side = lambda k: docs.select(F.col("id").alias(k), F.col(column).alias(f"text_{k}"))
    return pairs.join(side("a"), "a").join(side("b"), "b")


#: Characters of a segment, and of the cells of places in which segments are looked for.
SEGMENT, CELL = 8, 64
#: Tasks, at least, that meet and match prefixes.
MATCHERS = 96
#: Lengths whose quotient is at most P.DUP_LEN_RATIO lie in one bin or in neighbours.
BIN = 1.25
#: Texts of a bin's part: such a share of all, within bounds that a task holds.
PARTS, LEAST_PART, MOST_PART = 64, 1_024, 32_768
#: Rows that are met at once, at least; rows whose runs are held at once; partners in a row of candidates.
LOT, BLOCK, PARTNERS = 8_192, 2_048, 32
#: Matching segments, and candidates, that are spread out at once.
SPREAD = 2_000_000
_HEAD = "room string, id long, k binary, len int, head string"
_CANDIDATE = "room string, lo long, hi long, head string, los array<long>, his array<long>, heads array<string>"


def room(chapter: str = "chapter") -> Column:
    """A chapter as a text that is never null, also where there is no chapter."""
    return F.coalesce(F.concat(F.lit("="), F.col(chapter).cast("string")), F.lit(""))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Near-duplicate stems of ``docs (chapter, id, text)``: a, b, ratio (3 digits); see ``near_duplicates_by_room``."""
    return near_duplicates_by_room(docs).select("a", "b", "ratio")


def near_duplicates_by_room(docs: DataFrame) -> DataFrame:
    """Near-duplicate stems of ``docs (chapter, id, text)``: room, a, b, ratio (3 digits).

    Both texts have the least length, the length ratio is bounded, and the sequence matcher's ratio of the prefixes
    (with its junk heuristic, as is) decides. Equal normalised texts of a chapter are a class: each of its members is
    paired with the class's smallest id (ratio 1), and only that id is paired with other classes. An id is one record, and
    records without a chapter are a chapter (room '').

    The matcher's ratio depends on which text comes first, and the smaller id does. Two classes are a pair if any of their
    members are: their smallest ids come in one order, and other members may come in the other.

    No pair is lost. A ratio of r leaves at most (1 - r)(m + n) characters of prefixes of m and n unmatched, so of one
    segment more than that, cut from the one prefix, some stand unharmed in the other, moved by no more places than there are
    unmatched characters. With the bounds here a segment has SEGMENT characters and more.

    Only prefixes are shuffled: texts of a bin of lengths meet each other and those of the next bin, a bin of many texts in
    parts, each pair of parts in a task. There segments meet the others' runs of SEGMENT characters in the same cells of places.
    """
    rows = docs.where("id is not null").select(room().alias("room"), F.col("id").cast("long").alias("id"), X.norm(F.col("text")).alias("text"))
    heads = rows.mapInArrow(_cut, _HEAD).persist(StorageLevel.DISK_ONLY)  # every text is normalised once
    bin_ = F.floor(F.ln("len") / math.log(BIN)).cast("int").alias("bin")
    in_room = Window.partitionBy("room").orderBy("bin")
    parts = heads.groupBy("room", bin_).agg(F.count("*").alias("n")).persist()
    total = parts.agg(F.sum("n")).first()[0] or 0  # parts are of known size then, so the prefixes need not be shuffled to meet them
    parts = parts.withColumn("g", F.ceil(F.col("n") / min(MOST_PART, max(LEAST_PART, total // PARTS))).cast("int"))
    beside = lambda f, step: F.when(f("bin").over(in_room) == F.col("bin") + step, f("g").over(in_room)).otherwise(0)
    parts = parts.select("room", "bin", "n", "g", beside(F.lead, 1).alias("after"), beside(F.lag, -1).alias("before"))

    classes = heads.groupBy("k").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), *[F.first(c).alias(c) for c in ("room", "len", "head")])
    copies = heads.select("k", "id").join(classes.where("lo < hi").select("k", "lo", "room"), "k").where("id <> lo")
    copies = copies.select("room", F.col("lo").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("ratio"))

    d = classes.withColumn("bin", bin_).join(parts, ["room", "bin"]).withColumn("p", F.pmod(F.xxhash64("k"), F.col("g")).cast("int"))
    p, bin_, name = F.col("p"), F.col("bin"), lambda *c: F.concat_ws("-", *c, F.col("room"))
    upto = lambda g, body: F.when(F.col(g) > 0, F.transform(F.sequence(F.lit(0), F.col(g) - 1), body)).otherwise(F.array())
    # side 0 gives segments, 1 runs, 2 both
    own = upto("g", lambda q: F.struct(name(bin_, F.least(p, q), F.lit(0), F.greatest(p, q)).alias("task"), F.when(p == q, 2).when(p < q, 0).otherwise(1).alias("side")))
    after = upto("after", lambda q: F.struct(name(bin_, p, F.lit(1), q).alias("task"), F.lit(0).alias("side")))
    before = upto("before", lambda q: F.struct(name(bin_ - 1, q, F.lit(1), p).alias("task"), F.lit(1).alias("side")))
    dealt = d.select("room", "lo", "hi", "len", "head", F.explode(F.concat(F.when(F.col("n") > 1, own).otherwise(F.array()), after, before)).alias("t"))
    # rows are few bytes and much work, so tasks must not be joined by their bytes
    tasks = max(MATCHERS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.select("t.task", "t.side", "room", "lo", "hi", "len", "head").repartition(tasks, "task").sortWithinPartitions("task")
    met = dealt.mapInArrow(_meet, _CANDIDATE).repartition(tasks)
    scored = met.mapInPandas(_match, "room string, a long, b long, ratio double").withColumn("ratio", F.round("ratio", 3))
    return scored.unionByName(copies).groupBy("room", "a", "b").agg(F.max("ratio").alias("ratio"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length, digest (with the room) and prefix of long enough texts."""
    for b in batches:
        out = [
            (r, i, hashlib.blake2b(f"{len(r)} {r}{t}".encode(), digest_size=16).digest(), len(t), t[: P.DUP_PREFIX])
            for r, i, t in zip(*(c.to_pylist() for c in b.columns))
            if len(t) >= P.DUP_MIN_LEN
        ]
        types = (pa.string(), pa.int64(), pa.binary(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=["room", "id", "k", "len", "head"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates among rows that come in the order of their task; small tasks are met together."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= LOT:
            t = pa.Table.from_batches(held)
            last = t.column("task").index(t.column("task")[-1]).as_py()
            if last:
                yield from _met(t.slice(0, last))
                held, rows = t.slice(last).to_batches(), t.num_rows - last
    if rows:
        yield from _met(pa.Table.from_batches(held))


def _spread(count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i, count[i] times: i, and 0, 1, ... count[i] - 1."""
    i = np.repeat(np.arange(len(count)), count)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)


def _grams(heads: list[str], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the given rows: the code points one after another, where each row begins, and a hash of SEGMENT characters from each place."""
    some = [heads[r] for r in rows]
    codes = np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    begin = np.cumsum([0, *map(len, some)])[:-1]
    h = np.zeros(max(0, len(codes) - SEGMENT + 1), np.uint64)
    for j in range(SEGMENT):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + len(h)]
    return codes, begin, h


def _key(h: np.ndarray, task: np.ndarray, cell: np.ndarray) -> np.ndarray:
    k = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + task.astype(np.uint64) * np.uint64(0x94D049BB133111EB) + cell.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    k = (k ^ (k >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return k ^ (k >> np.uint64(32))


def _once(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """In the order of keys, each key once a row."""
    o = np.lexsort((row, key))
    key, row = key[o], row[o]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def _met(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of rows of a task that can reach the ratio: each row with its partners."""
    heads, rooms = t.column("head").to_pylist(), t.column("room").to_pylist()
    task = t.column("task").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    side, lo, hi, size = (t.column(c).to_numpy() for c in ("side", "lo", "hi", "len"))
    n = np.fromiter(map(len, heads), np.int64, len(heads))
    # unmatched at most: the other prefix is longer than this one by its share
    most = np.floor((1 - P.DUP_RATIO) * (n + np.minimum(P.DUP_PREFIX, np.floor(n * (2 - P.DUP_RATIO) / P.DUP_RATIO + 1e-9))) + 1e-9).astype(np.int64)
    bag, blocks = np.zeros((len(heads), 64), np.uint16), lambda rows: (rows[i : i + BLOCK] for i in range(0, len(rows), BLOCK))
    keys, owners = [], []
    for rows in blocks(np.arange(len(heads))):
        codes, begin, h = _grams(heads, rows)
        of = np.repeat(np.arange(len(rows)), n[rows])
        bag[rows] = np.bincount(of * 64 + (codes % np.uint64(64)).astype(np.int64), minlength=len(rows) * 64).reshape(-1, 64)
        gives = np.flatnonzero(side[rows] != 1)
        i, j = _spread(most[rows][gives] + 1)
        i = gives[i]
        at, m = j * n[rows][i] // (most[rows][i] + 1), most[rows][i]
        first = np.maximum(at - m, 0) // CELL
        s, c = _spread((at + m) // CELL - first + 1)
        i, at, cell = i[s], at[s], first[s] + c
        keys.append(_key(h[begin[i] + at], task[rows][i], cell))
        owners.append(rows[i])
    skey, owner = _once(np.concatenate(keys), np.concatenate(owners))
    known = np.zeros(1 << 24, bool)
    known[skey >> np.uint64(40)] = True
    place = np.cumsum(side != 1) - 1  # of rows that give segments
    givers = np.flatnonzero(side != 1)
    for rows in blocks(np.flatnonzero(side != 0)):
        _, begin, h = _grams(heads, rows)
        i, at = _spread(n[rows] - SEGMENT + 1)
        key = _key(h[begin[i] + at], task[rows][i], at // CELL)
        some = known[key >> np.uint64(40)]
        key, i = _once(key[some], i[some])
        left = np.searchsorted(skey, key)
        count = np.searchsorted(skey, key, "right") - left
        key, i, left, count = (v[count > 0] for v in (key, i, left, count))
        seen, upto, begin = np.zeros((len(givers), len(rows)), bool), np.cumsum(count), 0
        while begin < len(count):
            end = max(begin + 1, np.searchsorted(upto, (upto[begin - 1] if begin else 0) + SPREAD, "right"))
            s, c = _spread(count[begin:end])
            seen[place[owner[left[begin:end][s] + c]], i[begin:end][s]] = True
            begin = end
        flat = np.flatnonzero(seen)
        for f in (flat[k : k + SPREAD] for k in range(0, len(flat), SPREAD)):
            x, y = givers[f // len(rows)], rows[f % len(rows)]
            total = P.DUP_RATIO * (n[x] + n[y]) - 1e-9
            fit = (task[x] == task[y]) & ((side[x] != 2) | (x < y)) & (lo[x] != lo[y])
            fit &= (np.maximum(size[x], size[y]) <= np.minimum(size[x], size[y]) * P.DUP_LEN_RATIO) & (2 * np.minimum(n[x], n[y]) >= total)
            x, y, total = x[fit], y[fit], total[fit]
            # an upper bound first: characters in common, whatever their order
            fit = np.concatenate([np.zeros(0, bool), *(2 * np.minimum(bag[x[k : k + LOT]], bag[y[k : k + LOT]]).sum(1, dtype=np.int64) >= total[k : k + LOT] for k in range(0, len(x), LOT))])
            x, y = x[fit], y[fit]
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]]) if len(x) else np.zeros(0, np.int64)
            groups = [(x[a], y[k : min(k + PARTNERS, b)]) for a, b in zip(first, np.r_[first[1:], len(x)]) for k in range(a, b, PARTNERS)]
            for gs in (groups[k : k + 256] for k in range(0, len(groups), 256)):
                own = [g for g, _ in gs]
                columns = [[rooms[g] for g in own], lo[own], hi[own], [heads[g] for g in own], [lo[ys] for _, ys in gs], [hi[ys] for _, ys in gs], [[heads[k] for k in ys] for _, ys in gs]]
                types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)], names=["room", "lo", "hi", "head", "los", "his", "heads"])


def _match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The matcher's ratio of candidates that reach it, the smaller id's prefix first, or the other if classes have members in that order."""
    for b in batches:
        out = []
        for r in b.itertuples():
            for lo, hi, head in zip(r.los, r.his, r.heads):
                one, two = sorted([(r.lo, r.hi, r.head), (lo, hi, head)])
                ratio = SequenceMatcher(None, one[2], two[2]).ratio()
                if ratio < P.DUP_RATIO and two[0] < one[1]:
                    ratio = SequenceMatcher(None, two[2], one[2]).ratio()
                if ratio >= P.DUP_RATIO:
                    out.append((r.room, one[0], two[0], ratio))
        yield pd.DataFrame(out, columns=["room", "a", "b", "ratio"])


def shared_segments(docs: DataFrame) -> DataFrame:
    """Foreign segments of ``docs (chapter, id, text)``: a, b, common, longest, suspect.

    Both texts are long, share enough shingles, and have a contiguous block of tokens with enough
    characters in common; the longer text is the suspect, the second of equal ones.
    """
    d = docs.where(F.char_length("text") > P.SEGMENT_TEXT_LEN)
    pairs = _texts(shared_shingles(d).select("a", "b", "common"), d, "text")

    def longest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, y in zip(b["text_a"], b["text_b"]):
                s, t = x.lower().split(), y.lower().split()
                m = SequenceMatcher(None, s, t).find_longest_match(0, len(s), 0, len(t))
                out.append(len(" ".join(s[m.a : m.a + m.size])))
            suspect = [i if len(x) > len(y) else j for i, j, x, y in zip(b["a"], b["b"], b["text_a"], b["text_b"])]
            yield pd.DataFrame({"a": b["a"], "b": b["b"], "common": b["common"], "longest": out, "suspect": suspect})

    return pairs.mapInPandas(longest, "a long, b long, common long, longest long, suspect long").where(F.col("longest") >= P.SEGMENT_MIN_CHARS)


def evidence(candidates: DataFrame, pages: DataFrame, n: int = P.SEGMENT_N) -> DataFrame:
    """Overlap of ``candidates (id, text)`` with each of ``pages (page, text)`` that shares a shingle: id, page, score, verdict."""
    sh = lambda df, k: df.select(k, F.explode(F.transform(X.shingles(F.col("text"), n), lambda s: F.xxhash64(s))).alias("h"))
    pairs = sh(candidates, "id").join(sh(pages, "page"), "h").select("id", "page").distinct()
    both = pairs.join(candidates.select("id", X.tokens(F.col("text")).alias("c")), "id").join(pages.select("page", X.tokens(F.col("text")).alias("p")), "page")
    return both.select("id", "page", X.overlap(F.col("c"), F.col("p")).alias("score")).withColumn("verdict", verdict(F.col("score")))


def verdict(score):
    """Auto-apply, human queue or reject, by evidence."""
    return F.when(score >= P.AUTO_APPLY_MIN, "auto").when(score >= P.HUMAN_QUEUE_MIN, "human").otherwise("reject")
