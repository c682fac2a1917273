"""SimHash near-duplicates: a self-join of binary tries under a Hamming budget.

Fingerprints are made next to the texts, in Arrow batches. Equal ones are merged before
anything else. Two that differ in at most ``budget`` of 64 bits agree on at least
``blocks - budget`` of any ``blocks`` blocks of bits, so each choice of that many blocks is
one forest of tries: the agreed bits name the trie, and only inside it pairs of nodes are
walked down together, with the differing bits so far, until they exceed the budget. With more
fingerprints, more blocks are taken, so tries stay small.

A crowded trie is dealt out: its fingerprints are split into k parts and each pair of parts
is a task of its own, k growing with the root of their number. A task returns a
spanning forest of what it linked, not the pairs, so a dense group gives no more rows than it
has fingerprints in its tries.

64 bits tell similarities apart only roughly. ``similar_groups`` therefore takes wide fingerprints
of distinct shingles: WIDE words of 64 bits to compare, and further bits cut into blocks, each block
a forest of tries, with as many blocks as let a pair of similarity 0.8 meet in one of them with a
chance of MEET. Tries are walked in pairs as above, pairs within NEAR bits of all WIDE words are joined to
minimum spanning forests, and their links are confirmed by the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

SEED = 42
#: The least Jaccard similarity of near copies, and the share of bits in which SimHashes of such a pair differ on average:
#: the angle between two sets with that similarity, over pi.
LEAST = 0.8
DIFFER = float(np.arccos(2 * LEAST / (1 + LEAST)) / np.pi)
#: Words of 64 bits that are compared; bits in which a pair may differ to be confirmed (2.5 standard deviations over the mean),
#: and in the first word alone; a pair within SURE bits (4 below) needs no confirmation.
WIDE = 8
_MEAN, _DEV = 64 * WIDE * DIFFER, float(np.sqrt(64 * WIDE * DIFFER * (1 - DIFFER)))
NEAR, FIRST, SURE = int(_MEAN + 2.5 * _DEV), 20, int(_MEAN - 4 * _DEV)
#: Chance that a pair of the least similarity agrees on a block at least; fingerprints of an average wide trie, at most.
MEET, WIDE_TRIE = 0.97, 512
#: Links held before they are thinned to a forest.
HELD = 1 << 20
#: Shingles hashed at once, so that a very long text needs no more memory than others.
CHUNK = 1 << 16
#: Node pairs walked at once.
FRONT = 1 << 17
#: Fingerprints that a trie has on average, at most; beyond that more blocks are taken.
TRIE = 1024
#: A trie of more fingerprints than this (and than four average ones) is dealt out in parts.
CROWD = 512


def text_fingerprint(text: str | None, words: int) -> int:
    """SimHash of one text: A-Z lower-cased, shingles of ``words`` words, repeats included.

    Fewer words give one shingle of all of them, none give zero. A bit is 1 if more than half
    of the hashes have it.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts]).tolist()
    stops = (ends - 1).tolist()[min(words, len(parts)) - 1 :]
    bits, total, digest = np.zeros(64, np.int64), len(stops), xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        part = stops[at : at + CHUNK]
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], part)), np.uint64, len(part))
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 5, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``docs (keys, text)`` to the keys and fp (64 bits as a signed long). A null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([text_fingerprint(t, words) for t in b.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.select(list(keys)).columns, pa.array(fp)], names=[*keys, "fp"])

    schema = T.StructType([*docs.select(*keys).schema.fields, T.StructField("fp", T.LongType())])
    return common.map_in_arrow(docs.select(*keys, "text"), run, schema)


def _walk(fp: np.ndarray, roots: np.ndarray, budget: int, leaf, equal) -> None:
    """Walk pairs of trie nodes together. roots: rows (a_from, a_to, b_from, b_to), each side a sorted run of uint64.

    A trie node is a range of a run at a depth, so nothing is built: at each bit the ranges are
    split by running counts of zero bits. Pairs of small ranges go to ``leaf`` as two index arrays,
    pairs of ranges of equal fingerprints to ``equal`` as four bounds.
    """
    zeros: dict[int, np.ndarray] = {}

    def zeros_at(bit: int) -> np.ndarray:
        if bit not in zeros:
            zeros[bit] = np.concatenate([[0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1) == 0)])
        return zeros[bit]

    stack = [(63, *(roots[:, i].astype(np.int64) for i in range(4)), np.zeros(len(roots), np.int64))]
    while stack:
        bit, alo, ahi, blo, bhi, diff = stack.pop()
        if len(alo) > FRONT:
            for at in range(0, len(alo), FRONT // 2):
                stack.append((bit, *(x[at : at + FRONT // 2] for x in (alo, ahi, blo, bhi, diff))))
            continue
        small = (ahi - alo) * (bhi - blo) <= 16
        if small.any():
            leaf(*_all_pairs(alo[small], ahi[small], blo[small], bhi[small]))
            alo, ahi, blo, bhi, diff = (x[~small] for x in (alo, ahi, blo, bhi, diff))
        if not len(alo):
            continue
        if bit < 0:
            equal(alo, ahi, blo, bhi)
            continue
        z = zeros_at(bit)
        am, bm = alo + z[ahi] - z[alo], blo + z[bhi] - z[blo]
        same = (alo == blo) & (ahi == bhi)
        kids = [(alo, am, blo, bm, diff), (am, ahi, bm, bhi, diff), (alo, am, bm, bhi, diff + 1)]
        kids.append(tuple(x[~same] for x in (am, ahi, blo, bm, diff + 1)))
        nxt = [np.concatenate(x) for x in zip(*kids)]
        keep = (nxt[1] > nxt[0]) & (nxt[3] > nxt[2]) & (nxt[4] <= budget)
        stack.append((bit - 1, *(x[keep] for x in nxt)))


def _all_pairs(alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of members of ranges, as two index arrays."""
    na, nb = ahi - alo, bhi - blo
    n = na * nb
    which = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    return alo[which] + k // nb[which], blo[which] + k % nb[which]


def trie_links(fp: np.ndarray, roots: np.ndarray, budget: int) -> np.ndarray:
    """Labels of the components that pairs within ``budget`` bits make of sorted runs of distinct fingerprints.

    roots as for ``_walk``; a side may be joined with itself.
    """
    label = np.arange(len(fp))

    def leaf(u: np.ndarray, v: np.ndarray) -> None:
        near = (np.bitwise_count(fp[u] ^ fp[v]) <= budget) & (u != v)
        common.merge_labels(label, u[near], v[near])

    _walk(fp, roots, budget, leaf, lambda alo, ahi, blo, bhi: common.merge_labels(label, alo, blo))
    return label


def forest(n: int, u: np.ndarray, v: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Which of the links (u, v) of n nodes make a minimum spanning forest by distance d (Boruvka's rounds)."""
    order = np.argsort(d, kind="stable")
    label, chosen = np.arange(n), []
    while len(order):
        a, b = label[u[order]], label[v[order]]
        open_ = a != b
        order, a, b = order[open_], a[open_], b[open_]
        best = np.full(n, len(order))
        np.minimum.at(best, a, np.arange(len(order)))
        np.minimum.at(best, b, np.arange(len(order)))
        pick = order[np.unique(best[best < len(order)])]
        chosen.append(pick)
        common.merge_labels(label, u[pick], v[pick])
    return np.concatenate(chosen) if chosen else np.empty(0, np.int64)


def wide_forest(wide: np.ndarray, roots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning forests (u, v, distance) of the pairs of wide fingerprints within NEAR bits; runs are sorted by the first word."""
    first = np.ascontiguousarray(wide[:, 0])
    held, count = [(np.empty(0, np.int64),) * 3], 0

    def leaf(u: np.ndarray, v: np.ndarray) -> None:
        nonlocal count
        some = (np.bitwise_count(first[u] ^ first[v]) <= FIRST) & (u != v)
        u, v = u[some], v[some]
        for at in range(0, len(u), 1 << 16):
            x, y = u[at : at + (1 << 16)], v[at : at + (1 << 16)]
            d = np.bitwise_count(wide[x] ^ wide[y]).sum(axis=1, dtype=np.int64)
            near = d <= NEAR
            held.append((x[near], y[near], d[near]))
            count += int(near.sum())
            if count >= HELD:
                count = thin()

    def thin() -> int:
        u, v, d = (np.concatenate(c) for c in zip(*held))
        keep = forest(len(first), u, v, d)
        held[:] = [(u[keep], v[keep], d[keep])]
        return len(keep)

    def equal(alo, ahi, blo, bhi) -> None:
        for x in zip(alo, ahi, blo, bhi):
            step = max(1, (1 << 18) // int(x[3] - x[2]))
            for at in range(int(x[0]), int(x[1]), step):
                leaf(*_all_pairs(*(np.array([y]) for y in (at, min(at + step, int(x[1])), x[2], x[3]))))

    _walk(first, roots, FIRST, leaf, equal)
    thin()
    return held[0]


def _blocks(n: int, budget: int) -> tuple[list[int], int]:
    """(masks of the choices of agreeing blocks, fingerprints of n in an average trie): enough blocks for TRIE."""
    for blocks in range(budget + 1, budget + 5):
        cuts = [64 * i // blocks for i in range(blocks + 1)]
        masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
        agree = blocks - budget
        mean = n >> (64 * agree // blocks)
        if mean <= TRIE or blocks == budget + 4:
            return [sum(c) for c in combinations(masks, agree)], mean
    raise AssertionError


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(rows: DataFrame, mean: float, split: str, order: str) -> DataFrame:
    """``rows (c, key, ...)`` with i, j, p: the tasks (c, key, i, j) that a row goes to, and which of the two parts it is in.

    A trie of many rows is dealt out in k parts by the column ``split``, each pair of parts a task. Rows of a
    task come together and sorted by p and ``order``.
    """
    crowds = rows.groupBy("c", "key").agg(F.count("*").alias("n")).where(F.col("n") > max(CROWD, 4 * mean))
    crowds = crowds.select("c", "key", F.ceil(F.sqrt(F.col("n") / 64)).cast("int").alias("k"))
    rows = rows.join(common.written(crowds, "simhash-crowds"), ["c", "key"], "left")
    k = F.coalesce("k", F.lit(1))
    rows = rows.withColumn("k", k).withColumn("p", F.pmod(F.xxhash64(split), F.col("k")).cast("int"))
    rows = rows.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.withColumn("i", F.least("p", "q")).withColumn("j", F.greatest("p", "q")).drop("k", "q")
    return rows.repartition("c", "key", "i", "j").sortWithinPartitions("c", "key", "i", "j", "p", order)


def _tasks(batches: Iterator[pd.DataFrame], walk) -> Iterator[pd.DataFrame]:
    """``walk`` over runs of whole tasks of what ``_dealt`` gave."""
    by = ["c", "key", "i", "j"]
    held: list[pd.DataFrame] = []
    n = 0
    for b in batches:
        held.append(b)
        n += len(b)
        if n >= 1 << 16:  # whole tries only; the last one may go on in the next batch
            part = pd.concat(held)
            last = (part[by] != part[by].iloc[-1]).any(axis=1).to_numpy().nonzero()[0]
            if len(last):
                yield walk(part.iloc[: last[-1] + 1])
                held = [part.iloc[last[-1] + 1 :]]
            else:
                held = [part]
            n = len(held[0])
    if n:
        yield walk(pd.concat(held))


def _roots(part: pd.DataFrame) -> np.ndarray:
    """Pairs of runs to walk, as bounds: a part with itself, or the two parts of a task."""
    keys = part[["c", "key", "i", "j", "p"]].to_numpy()
    task = np.concatenate([[True], (keys[1:, :4] != keys[:-1, :4]).any(axis=1)])
    side = task | np.concatenate([[True], keys[1:, 4] != keys[:-1, 4]])
    start = np.flatnonzero(side)
    stop = np.append(start[1:], len(keys))
    first = task[start]
    alone = keys[start, 2] == keys[start, 3]
    lead = np.flatnonzero(first & alone)
    a = np.flatnonzero(first & ~alone)
    a = a[(a + 1 < len(start))]
    a = a[~first[a + 1]]
    return np.concatenate([np.stack([start[x], stop[x], start[y], stop[y]], axis=1) for x, y in ((lead, lead), (a, a + 1))])


def links(fps: DataFrame, budget: int = 4) -> DataFrame:
    """Spanning links (u, v) among distinct fingerprints ``fps (fp)`` that differ in at most ``budget`` bits."""
    masks, mean = _blocks(fps.count(), budget)
    which = F.explode(F.arrays_zip(F.array(*map(F.lit, range(len(masks)))).alias("c"), F.array(*[F.lit(_signed(m)) for m in masks]).alias("m")))
    rows = fps.select("fp", which.alias("w")).select(F.col("w.c").alias("c"), F.col("fp").bitwiseAND(F.col("w.m")).alias("key"), "fp")
    # unsigned order, so that a trie node is one range
    dealt = _dealt(rows.withColumn("fp", F.col("fp").bitwiseXOR(F.lit(_signed(1 << 63)))), mean, "fp", "fp")

    def walk(part: pd.DataFrame) -> pd.DataFrame:
        fp = part["fp"].to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
        label = trie_links(fp, _roots(part), budget)
        at = np.flatnonzero(label != np.arange(len(label)))
        return pd.DataFrame({"u": fp[at].view(np.int64), "v": fp[label[at]].view(np.int64)})

    return common.map_in_pandas(dealt, lambda batches: _tasks(batches, walk), "u long, v long")


def near_groups(docs: DataFrame, words: int = 5, budget: int = 4, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Near-duplicate groups of ``docs (doc_id, text)``: the keys (doc_id and others), fp, part, component_id.

    part is the fingerprint that stands for the group.

    Fingerprints that differ in at most ``budget`` bits are linked; component_id is the smallest
    doc_id that links reach, the document included. Repeated rows and equal fingerprints share a component
    without links of their own. Documents without words have fingerprint zero and are linked like
    others. Null ids are members and bridges but never name a component, unless it has no other id
    (then it is null). An empty table gives no rows.
    """
    docs = common.written(fingerprints(docs, words, keys), "simhash-fp")
    fps = common.written(docs.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    parts = common.components(links(fps.select("fp"), budget))
    named = fps.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("part", F.coalesce("component", "fp"))
    least = named.groupBy("part").agg(F.min("rep").alias("component_id"))
    named = named.select("fp", "part").join(least, "part").select("fp", "part", "component_id")
    return docs.join(named, "fp").select(*keys, "fp", "part", "component_id")


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the shingles that a SimHash of the text counts; none without words."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = (ends - [len(p) + 1 for p in parts]).tolist()
    stops = (ends - 1).tolist()[min(words, len(parts)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, stops)), np.uint64, len(stops)))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two sorted sets is LEAST or more."""
    if not len(a) or not len(b):
        return len(a) == len(b)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return 9 * both >= 4 * (len(a) + len(b))


def wide_fingerprint(shingles: np.ndarray, words: int) -> np.ndarray:
    """SimHash of ``words`` words of 64 bits: each word counts another mixing of the shingles' hashes (splitmix64)."""
    counts = np.zeros((words, 64), np.int64)
    salt = np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(shingles), 255):  # so that a byte holds a count
        x = shingles[at : at + 255, None] + salt
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        counts += np.add.reduce(np.unpackbits(x.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8).reshape(words, 64)
    return np.packbits(counts * 2 > len(shingles), axis=1, bitorder="little").view(np.uint64)[:, 0]


def _forests(n: int) -> tuple[int, int]:
    """(bits of a block, blocks) for n fingerprints: tries of WIDE_TRIE on average, and enough blocks for MEET."""
    bits = min(32, max(4, int(np.ceil(np.log2(max(n, 1) / WIDE_TRIE)))))
    return bits, int(np.ceil(np.log(1 - MEET) / np.log(1 - (1 - DIFFER) ** bits)))


def wide_fingerprints(keyed: DataFrame, words: int, bits: int, blocks: int) -> DataFrame:
    """doc_id, _h, sid (names equal fingerprints; null without words), first (of the WIDE words), wide (all), keys (the blocks)."""
    per = 64 // bits
    total = WIDE + -(-blocks // per)
    at = np.arange(blocks)
    word, shift, mask = WIDE + at // per, (at % per * bits).astype(np.uint64), np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = (shingle_set(t.as_py(), words) for t in b.column("text"))
            fps = [wide_fingerprint(s, total) if len(s) else None for s in sets]
            cols = [
                pa.array([None if f is None else xxhash.xxh3_64_intdigest(f.tobytes()) - (1 << 63) for f in fps], pa.int64()),
                pa.array([None if f is None else int(f[0] ^ np.uint64(1 << 63)) - (1 << 64) * int(f[0] < 1 << 63) for f in fps], pa.int64()),
                pa.array([None if f is None else f[:WIDE].tobytes() for f in fps], pa.binary()),
                pa.array([None if f is None else ((f[word] >> shift) & mask).astype(np.int64) for f in fps], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_h"), *cols], names=["doc_id", "_h", "sid", "first", "wide", "keys"])

    fields = [T.StructField("sid", T.LongType()), T.StructField("first", T.LongType()), T.StructField("wide", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType()))]
    return common.map_in_arrow(keyed.select("doc_id", "_h", "text"), run, T.StructType([*keyed.select("doc_id", "_h").schema.fields, *fields]))


def wide_links(fps: DataFrame, mean: float) -> DataFrame:
    """Links (u, v, d) of ``fps (sid, first, wide, keys)``: minimum spanning forests of every task's pairs, u < v, each once."""
    rows = fps.select("sid", "first", "wide", F.posexplode("keys").alias("c", "key"))
    dealt = _dealt(rows, mean, "sid", "first")

    def walk(part: pd.DataFrame) -> pd.DataFrame:
        part = part.reset_index(drop=True)
        wide = np.frombuffer(b"".join(part["wide"]), np.uint64).reshape(len(part), WIDE)
        u, v, d = wide_forest(wide, _roots(part))
        sid = part["sid"].to_numpy()
        return pd.DataFrame({"u": np.minimum(sid[u], sid[v]), "v": np.maximum(sid[u], sid[v]), "d": d})

    found = common.map_in_pandas(dealt, lambda batches: _tasks(batches, walk), "u long, v long, d long")
    return found.groupBy("u", "v").agg(F.min("d").alias("d"))


def confirmed(keyed: DataFrame, reps: DataFrame, pairs: DataFrame, words: int) -> DataFrame:
    """The ``pairs (u, v)`` of sids whose whole shingle sets are similar; reps (sid, rep_id, rep_h): a document of each."""
    ends = pairs.select(F.col("u").alias("sid")).union(pairs.select(F.col("v").alias("sid"))).distinct()
    some = reps.join(ends, "sid")
    texts = keyed.select("doc_id", "_h", "text").join(some, F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("_h") == F.col("rep_h"))).select("sid", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 512):
                part = b.slice(lo, 512)
                yield pa.RecordBatch.from_arrays([part.column("sid"), pa.array([shingle_set(t.as_py(), words).tobytes() for t in part.column("text")], pa.binary())], names=["sid", "shingles"])

    # repeated rows of one document give one set
    of = common.written(common.map_in_arrow(texts.dropDuplicates(["sid"]), sets, "sid long, shingles binary"), "simhash-sets")
    sides = pairs.join(of.select(F.col("sid").alias("u"), F.col("shingles").alias("x")), "u").join(of.select(F.col("sid").alias("v"), F.col("shingles").alias("y")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column("x"), b.column("y")
            ok = pa.array([similar(*(np.frombuffer(c[i].as_buffer(), np.uint64) for c in (x, y))) for i in range(len(b))], pa.bool_())
            yield b.select(["u", "v"]).filter(ok)

    return common.map_in_arrow(sides.select("u", "v", "x", "y"), run, "u long, v long")


def similar_groups(keyed: DataFrame, words: int = 5) -> DataFrame:
    """``keyed (doc_id, _h, text)`` to doc_id, _h, part: documents linked by shingle similarities of LEAST or more share a part.

    Candidates come from wide SimHashes (see above): a pair of exactly the least similarity is missed with
    a chance of about 4 %, a more similar one with less. Links are confirmed by whole sets
    unless the distance leaves no doubt. Documents without words are alike. _h tells texts of one doc_id apart.
    """
    n = keyed.count()
    bits, blocks = _forests(n)
    docs = common.written(wide_fingerprints(keyed, words, bits, blocks), "simhash-wide")
    of = F.min(F.struct("doc_id", "_h")).alias("r")
    fps = docs.where("sid is not null").groupBy("sid").agg(F.first("first").alias("first"), F.first("wide").alias("wide"), F.first("keys").alias("keys"), of)
    fps = common.written(fps.select("sid", "first", "wide", "keys", F.col("r.doc_id").alias("rep_id"), F.col("r._h").alias("rep_h")), "simhash-distinct")
    pairs = common.written(wide_links(fps, n / 2**bits), "simhash-links")
    sure = pairs.where(F.col("d") <= SURE).select("u", "v")
    parts = common.components(sure.union(confirmed(keyed, fps.select("sid", "rep_id", "rep_h"), pairs.where(F.col("d") > SURE).select("u", "v"), words)))
    named = docs.select("doc_id", "_h", "sid").join(parts.withColumnRenamed("node", "sid"), "sid", "left")
    return named.select("doc_id", "_h", F.coalesce("component", "sid").alias("part"))


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, _h, _row: each row of ``docs`` in one column, so that no name of its clashes; _h tells texts of one doc_id apart."""
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")), F.col("text").isNull()).alias("_h"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def keep_first(keyed: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``keyed`` (packed) that stand for the parts of ``groups (doc_id, _h, part)``."""
    best = groups.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h")).alias("b")).select("b.doc_id", "b._h")
    times = groups.groupBy("doc_id", "_h").agg(F.count("*").alias("times"))
    times = times.select(F.col("doc_id").alias("id2"), F.col("_h").alias("h2"), "times")
    best = best.join(times, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("_h") == F.col("h2"))).select("id2", "h2", "times")
    kept = keyed.join(best, F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("_h") == F.col("h2")))
    alone = kept.where("times = 1").select("_row")
    # of rows with one id and text, the least as a whole: the same one at every run
    repeated = kept.where("times > 1").groupBy("id2", "h2").agg(F.min("_row").alias("_row")).select("_row")
    return alone.unionByName(repeated).select("_row.*")


def first_of_groups(docs: DataFrame, words: int = 5, budget: int | None = None) -> DataFrame:
    """``docs (doc_id, text, ...)`` with one row of each near-duplicate group: the smallest doc_id's.

    Without a ``budget`` groups are those of ``similar_groups`` (similarity LEAST or more), else of
    fingerprints that differ in at most ``budget`` bits. All columns are kept, whatever their names; they must be
    orderable. Among rows of that id the one with the smallest hash of its text stays; of rows that also
    have the text in common the least row. A null id stays only where a group has no other.
    """
    keyed = packed(docs)
    groups = similar_groups(keyed, words) if budget is None else near_groups(keyed, words, budget, ("doc_id", "_h"))
    return keep_first(keyed, groups)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: four-word shingles, four bits."""
    out = near_groups(common.table(spark, sf_dir, "documents", "doc_id", "text"), words=4, budget=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
