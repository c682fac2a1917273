"""Substring dedup: Rabin-Karp hashes of every fixed-length window of words, counted in Spark.

A window that starts anywhere else too is removed with all its words; repeated windows of a document
are merged into maximal intervals. The hashes are rolling polynomials modulo 2**64 over mixed
word hashes, taken from running sums of a whole batch of texts at once, in two lanes of 64 bits.
Both lanes are over one 64-bit hash of each word, and bytes are not compared after.

Counting every window would shuffle more than the input. Each window therefore is filed
under its minimizer: the word gram with the smallest hash among those inside it. Equal windows
have the same minimizer at the same place, and consecutive windows with one minimizer form a run,
so

* a gram that is a minimizer once in the corpus has only windows that occur once;
* if all runs of a gram have the same hash of all their words, all their windows repeat;
* else runs whose hash occurs twice repeat, and the windows of the others are hashed one by one
  and counted, together with those of one example of each repeated run of the same gram.

Every window is decided, none is sampled; the counts are sums over all documents. Hot
passages are counted with partial sums and joined on tables with unique keys, which lets Spark
split the hot side. Documents are known by a 128-bit hash of their text, so equal
texts share their intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words of the grams among which a window's minimizer is chosen, at most.
GRAM = 8
#: Bytes of text hashed at once.
BATCH = 1 << 20
#: Words of a run hashed at once; longer texts are cut with an overlap of a window.
STRETCH = 1 << 17
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
#: Bases of the polynomials; 3 modulo 8, so their powers minus 1 have few factors of two.
_BASES = [int(x) & ~7 | 3 for x in _rng.integers(0, 1 << 63, 3, dtype=np.uint64)]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        while len(self.up) < n:
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, x * (x[-1:] * b)]))


_POWERS = [_Powers(b) for b in _BASES]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each over all."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Rolling polynomial hashes of any stretch of a sequence."""

    def __init__(self, values: np.ndarray, powers: _Powers) -> None:
        powers.to(len(values) + 1)
        self.powers = powers
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers.up[: len(values)], dtype=np.uint64)])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self.sums[stop] - self.sums[start]) * self.powers.down[start])


def words_of(buf: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offset and hash of each word of a text."""
    raw = np.frombuffer(buf, np.uint8)
    solid = ~_SPACE[raw]
    edge = np.diff(np.concatenate([[0], solid.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    h = Rolling(_BYTE[raw], _POWERS[0]).of(start, stop)
    return start, _mix(h + (stop - start).astype(np.uint64))


def runs(texts: list[bytes], window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of windows with one minimizer: (text, gram hash, hash of a run's words, equal runs, first window, last window)."""
    gram = min(GRAM, window)
    span = window - gram + 1
    start, h = words_of(b"\n".join(texts))
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    text = np.searchsorted(bounds, start, side="right") - 1
    first = np.searchsorted(text, np.arange(len(texts)))
    for at in range(0, max(len(h) - window + 1, 0), STRETCH):
        part, doc = h[at : at + STRETCH + window - 1], text[at : at + STRETCH + window - 1]
        n = len(part) - window + 1
        a, b = Rolling(part, _POWERS[1]), Rolling(part, _POWERS[2])
        k = np.arange(len(part) - gram + 1)
        grams = a.of(k, k + gram)
        least = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
        whole = doc[:n] == doc[window - 1 :]
        new = np.concatenate([[True], (least[1:] != least[:-1]) | (doc[1:n] != doc[: n - 1])])
        # windows that reach into the next text end a run: they are the last of their text
        s = np.flatnonzero((new | np.concatenate([[True], ~whole[:-1]])) & whole)
        e = np.flatnonzero(whole & np.concatenate([new[1:] | ~whole[1:], [True]]))
        p = least[s]
        shape = ((p - s) * window + (e - s)).astype(np.uint64)
        g, all_ = grams[p], _mix(b.of(s, e + window) + shape)
        # equal runs that follow each other, as in a word repeated over and over, are one row
        head = np.ones(len(s), bool)
        head[1:] = (g[1:] != g[:-1]) | (all_[1:] != all_[:-1]) | (s[1:] != e[:-1] + 1) | (doc[s[1:]] != doc[s[:-1]])
        i = np.flatnonzero(head)
        n = np.diff(np.append(i, len(s)))
        s, e = s[i], e[i + n - 1]
        yield doc[s], g[i], all_[i], n, s + at - first[doc[s]], e + at - first[doc[s]]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("substrings"), text).alias("k2"))


def _batches(b: pd.DataFrame) -> Iterator[tuple[int, list[bytes]]]:
    held, size, at = [], 0, 0
    for i, t in enumerate(b["text"]):
        t = t.encode()
        if held and size + len(t) > BATCH:
            yield at, held
            held, size, at = [], 0, i
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def intervals(docs: DataFrame, window: int) -> DataFrame:
    """Repeated windows of keyed documents: k1, k2, s, e (first and last window of a stretch of repeated ones)."""

    def to_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            k1, k2 = b["k1"].to_numpy(), b["k2"].to_numpy()
            for at, texts in _batches(b):
                for d, g, h, n, s, e in runs(texts, window):
                    yield pd.DataFrame({"k1": k1[at + d], "k2": k2[at + d], "g": g.view(np.int64), "h": h.view(np.int64), "c": n, "s": s.astype(np.int32), "e": e.astype(np.int32)})

    def to_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k1, k2, text, packed in zip(b["k1"], b["k2"], b["text"], b["runs"]):
                _, h = words_of(text.encode())
                packed = np.asarray(packed, np.int64)
                s, n, many = packed >> 21, (packed >> 1) & 0xFFFFF, packed & 1
                n = n + 1
                pos = np.repeat(s - np.cumsum(n) + n, n) + np.arange(n.sum())
                w = [Rolling(h, p).of(pos, pos + window).view(np.int64) for p in _POWERS[1:]]
                yield pd.DataFrame({"k1": k1, "k2": k2, "pos": pos.astype(np.int32), "w1": w[0], "w2": w[1], "many": np.repeat(many, n).astype(np.int32)})

    keys = ["k1", "k2"]
    all_runs = common.written(common.map_in_pandas(docs, to_runs, "k1 long, k2 long, g long, h long, c long, s int, e int"), "sub-runs")
    seen = all_runs.groupBy("g").agg(F.sum("c").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    again = seen.where("n > 1").select("g", (F.col("lo") == F.col("hi")).alias("alike"))
    some = common.written(all_runs.join(again, "g"), "sub-again")
    alike = some.where("alike").select(*keys, "s", "e")

    mixed = some.where("not alike").drop("alike")
    spans = common.written(mixed.groupBy("g", "h").agg(F.sum("c").alias("n")), "sub-spans")
    odd = common.written(spans.groupBy("g").agg(F.min("n").alias("least")).where("least = 1").select("g"), "sub-odd")
    twice = mixed.join(spans.where("n > 1").drop("n"), ["g", "h"]).select(*keys, "s", "e")
    # a run is at most a window long, so 20 bits hold its length
    packed = lambda many: F.shiftleft(F.col("s").cast("long"), 21) + (F.col("e") - F.col("s")) * 2 + F.lit(many)
    once = mixed.join(spans.where("n = 1").drop("n"), ["g", "h"]).select(*keys, packed(0).alias("run"))
    shown = mixed.join(spans.where("n > 1").join(odd, "g").drop("n"), ["g", "h"])
    one = F.col("s") + F.floor((F.col("e") - F.col("s") + 1) / F.col("c")).cast("int") - 1
    shown = shown.groupBy("g", "h").agg(F.min(F.struct(*keys, "s", one.alias("e"))).alias("x")).select("x.*").select(*keys, packed(1).alias("run"))
    asked = once.unionByName(shown).groupBy(*keys).agg(F.collect_list("run").alias("runs"))
    single = docs.join(asked, keys).select(*keys, "text", "runs")
    windows = common.written(common.map_in_pandas(single, to_windows, "k1 long, k2 long, pos int, w1 long, w2 long, many int"), "sub-windows")
    found = windows.groupBy("w1", "w2").agg(F.sum(F.col("many") + 1).alias("n")).where("n > 1").drop("n")
    found = windows.where("many = 0").join(found, ["w1", "w2"]).select(*keys, F.col("pos").alias("s"), F.col("pos").alias("e"))
    return alike.unionByName(twice).unionByName(found).distinct()


def dedup(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs (doc_id, text)`` without the words of repeated windows: doc_id, n_words, n_removed, removed, kept.

    removed: maximal intervals [from, to) of word positions; kept: the other words, joined by a space. All
    copies of a repeated window go, those of one document included, judged on the input.
    Null and empty texts and texts shorter than a window lose nothing; repeated rows
    (same text, any id) count as each other's copies; ids are carried, never compared; an empty
    table gives no rows.
    """
    return _applied(docs, window, False)


def _applied(docs: DataFrame, window: int, digest: bool) -> DataFrame:
    if window >= 1 << 20:
        raise ValueError("a window has fewer than 2**20 words")
    docs = _keyed(docs)
    found = intervals(docs, window)
    place = F.shiftleft(F.col("s").cast("long"), 32) + F.col("e")
    found = found.groupBy("k1", "k2").agg(F.collect_list(place).alias("found"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc_id, text, places in zip(b["doc_id"], b["text"], b["found"]):
                words = text.encode().split()
                gaps, n = [], 0
                if places is not None:
                    p = np.asarray(places, np.int64)
                    depth = np.zeros(len(words) + 1, np.int32)
                    np.add.at(depth, p >> 32, 1)
                    np.add.at(depth, (p & 0xFFFFFFFF) + window, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    n = int(gone.sum())
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                    gaps = edge.reshape(-1, 2).tolist()
                    kept = b" ".join(compress(words, (~gone).tolist()))
                else:
                    kept = b" ".join(words)
                out.append((doc_id, len(words), n, hashlib.sha256(kept).hexdigest()) if digest else (doc_id, len(words), n, gaps, kept.decode()))
            yield pd.DataFrame(out, columns=names)

    kind = "kept_sha256 string" if digest else "removed array<array<int>>, kept string"
    kind = f"doc_id long, n_words long, n_removed long, {kind}"
    names = [x.split()[0] for x in kind.split(", ")]
    return common.map_in_pandas(docs.join(found, ["k1", "k2"], "left").select("doc_id", "text", "found"), cut, kind)


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated windows of 35 words."""
    return _applied(common.table(spark, sf_dir, "documents", "doc_id", "text"), 35, True)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
n AS (SELECT *, CAST(len(w) AS BIGINT) AS n_words FROM d),
win AS (
  SELECT r, i, md5(array_to_string(w[i : i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, n_words - 33)) AS i FROM n)),
rep AS (SELECT r, i FROM win WHERE h IN (SELECT h FROM win GROUP BY h HAVING count(*) > 1)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, n_words + 1)) AS p FROM n),
last AS (
  SELECT words.r, words.p, words.word, max(rep.i) OVER (PARTITION BY words.r ORDER BY words.p) AS i
  FROM words LEFT JOIN rep ON rep.r = words.r AND rep.i = words.p),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM last WHERE i IS NULL OR p > i + 34 GROUP BY r)
SELECT n.doc_id, n.n_words, CAST(n.n_words - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM n LEFT JOIN kept ON n.r = kept.r
"""
