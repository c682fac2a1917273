"""Language identification: a bidirectional gated recurrent network over bytes.

Two gated recurrent layers read the lower-cased UTF-8 bytes of a text, blanks included (a run of them as
one space), from both ends and label every position with a distribution over languages. A
document's distribution is the mean over all its positions.

A text is read in windows of WINDOW bytes, of which only the middle ones count: EDGE bytes on
either side let the state settle, so each position is labelled once and knows its surroundings across
words. Windows of many documents run side by side. The network is trained in numpy by backpropagation
through time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

UNDETERMINED = "und"
HIDDEN = 12
#: Bytes of a window, and those at either end that give context only.
WINDOW, EDGE = 256, 8
#: Bounds of the training sample: documents of a language, characters of a document.
SAMPLE_DOCS, SAMPLE_CHARS = 200, 4000
#: Steps of training, windows of a step and their bytes, greatest rate.
STEPS, BATCH, PIECE, RATE = 300, 160, 32, 0.012
#: Windows that run side by side, and bytes of text that a worker takes at once.
SIDE, AT_ONCE = 2048, 1 << 20
_LETTER = re.compile("[A-Za-z]")


def stream(text: str) -> bytes:
    """The bytes that the network reads: lower-cased, runs of ASCII blanks as one space, none at the ends."""
    return b" ".join(text.lower().encode("utf-8", "replace").split())


def has_letter(text: str | None) -> bool:
    return bool(text) and (bool(_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text))))


def windows(docs: list[bytes]) -> tuple[np.ndarray, ...]:
    """Windows over documents: (bytes, document, start, length, first and end of what counts); longest first.

    start is a place in the joined bytes; first and end are places in the window.
    """
    size = np.array([len(d) for d in docs], np.int64)
    core = WINDOW - 2 * EDGE
    many = -(-size // core)
    doc = np.repeat(np.arange(len(docs)), many)
    at = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * core
    lo, hi = np.maximum(at - EDGE, 0), np.minimum(at + core + EDGE, size[doc])
    begin = (np.cumsum(size) - size)[doc]
    order = np.argsort(lo - hi, kind="stable")
    parts = (doc, begin + lo, hi - lo, at - lo, np.minimum(at + core, size[doc]) - lo)
    return np.frombuffer(b"".join(docs), np.uint8), *(x[order] for x in parts)


def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte rows of equal width, and true lengths."""
    n = np.array([len(w) for w in words])
    width = int(n.max(initial=0))
    return np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width), n


def _mirrored(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each row's first n entries in reverse order."""
    at = n[:, None] - 1 - np.arange(x.shape[1])[None, :]
    return np.take_along_axis(x, np.where(at >= 0, at, np.arange(x.shape[1])[None, :]), axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class BiGru:
    """The network: for each direction byte weights W (with bias), state weights U; output weights V, c."""

    def __init__(self, langs: list[str], seed: int = 3) -> None:
        rng, h = np.random.default_rng(seed), HIDDEN
        small = lambda *s: (rng.standard_normal(s) * 0.3).astype(np.float32)
        self.langs = langs
        self.p = {"Wf": small(256, 3 * h), "Uf": small(h, 3 * h), "Wb": small(256, 3 * h), "Ub": small(h, 3 * h), "V": small(2 * h, len(langs)), "c": np.zeros(len(langs), np.float32)}

    def _run(self, x: np.ndarray, n: np.ndarray, side: str, keep: bool):
        """States after each byte; rows are sorted by falling length, so those still running come first."""
        w, u, h = self.p["W" + side], self.p["U" + side], HIDDEN
        states = np.zeros((x.shape[1], len(x), h), np.float32)
        state, kept = np.zeros((len(x), h), np.float32), []
        for t in range(x.shape[1]):
            a = int((n > t).sum())
            g, s = w[x[:a, t]], state[:a]
            m = s @ u
            zr = np.tanh((g[:, : 2 * h] + m[:, : 2 * h]) * 0.5) * 0.5 + 0.5
            z, r = zr[:, :h], zr[:, h:]
            new = np.tanh(g[:, 2 * h :] + r * m[:, 2 * h :])
            if keep:
                kept.append((a, s.copy(), z, r, new, m[:, 2 * h :]))
            state[:a] = new + z * (s - new)
            states[t, :a] = state[:a]
        return states, kept

    def _forward(self, x, n, keep=False):
        f, kf = self._run(x, n, "f", keep)
        y = _mirrored(x, n)
        b, kb = self._run(y, n, "b", keep)
        back = np.zeros_like(b)
        for t in range(x.shape[1]):  # the state that the backward layer has at position t
            live = np.flatnonzero(n > t)
            back[t, live] = b[n[live] - 1 - t, live]
        both = np.concatenate([f, back], axis=2)
        logits = both @ self.p["V"] + self.p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        e = np.exp(logits)
        return e / e.sum(axis=2, keepdims=True), both, y, kf, kb

    def _marks(self, x: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Logits (language, position, row) without the states that training keeps; rows are sorted by falling length."""
        width, h = x.shape[1], HIDDEN
        out = np.empty((len(self.langs), width, len(x)), np.float32)
        out[:] = self.p["c"][:, None, None]
        full = int((n == width).sum())
        for side, inp, v in (("f", x, self.p["V"][:h]), ("b", _mirrored(x, n), self.p["V"][h:])):
            # the gates apart, so that every array is one run of memory
            w, u = ([np.ascontiguousarray(self.p[k + side][:, i * h : (i + 1) * h]) for i in range(3)] for k in "WU")
            state = np.zeros((len(x), h), np.float32)
            for t in range(width):
                a = len(x) if t < n[-1] else int((n > t).sum())
                byte, s = inp[:a, t], state[:a]
                z, r, new = (s @ u[i] for i in range(3))
                z += w[0].take(byte, axis=0)
                r += w[1].take(byte, axis=0)
                new *= _sigmoid(r)
                new += w[2].take(byte, axis=0)
                new += new
                new = _sigmoid(new)  # tanh(x) is 2 sigmoid(2x) - 1; exp is the faster function here
                new += new
                new -= 1
                s -= new
                s *= _sigmoid(z)
                s += new
                y = v.T @ s.T
                if side == "f":
                    out[:, t, :a] += y
                else:
                    out[:, width - 1 - t, : min(a, full)] += y[:, :full]
                    rows = np.arange(full, a)
                    out[:, n[rows] - 1 - t, rows] += y[:, full:]
        return out

    def label(self, docs: list[bytes]) -> np.ndarray:
        """Sums over a document's positions of their distributions, a row a document."""
        data, doc, start, size, first, end = windows(docs)
        out = np.zeros((len(docs), len(self.langs)))
        for at in range(0, len(doc), SIDE):
            now = slice(at, at + SIDE)
            n = size[now]
            place = start[now, None] + np.minimum(np.arange(n[0])[None, :], n[:, None] - 1)
            e = self._marks(data[place], n)
            e -= e.max(axis=0)
            np.exp(e, out=e)
            e /= e.sum(axis=0)
            t = np.arange(n[0])[:, None]
            e *= (t >= first[now]) & (t < end[now])
            np.add.at(out, doc[now], e.sum(axis=1, dtype=np.float64).T)
        return out

    def gradients(self, words: list[bytes], langs: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        x, n = padded([words[i] for i in order])
        y = langs[order]
        prob, both, mirror, kf, kb = self._forward(x, n, True)
        live = np.arange(x.shape[1])[:, None] < n[None, :]
        total = live.sum()
        loss = -(np.log(prob[:, np.arange(len(y)), y] + 1e-12) * live).sum() / total
        d = prob.copy()
        d[:, np.arange(len(y)), y] -= 1
        d *= (live / total)[:, :, None]
        grad = {k: np.zeros_like(v) for k, v in self.p.items()}
        grad["V"] = np.einsum("tbh,tbk->hk", both, d)
        grad["c"] = d.sum(axis=(0, 1))
        to = d @ self.p["V"].T
        back = np.zeros_like(to[:, :, HIDDEN:])
        for t in range(x.shape[1]):
            rows = np.flatnonzero(n > t)
            back[n[rows] - 1 - t, rows] = to[t, rows, HIDDEN:]
        for side, inp, kept, ext in (("f", x, kf, to[:, :, :HIDDEN]), ("b", mirror, kb, back)):
            u, h = self.p["U" + side], HIDDEN
            carry = np.zeros((len(y), h), np.float32)
            for t in range(x.shape[1] - 1, -1, -1):
                a, s, z, r, new, mn = kept[t]
                ds = carry[:a] + ext[t, :a]
                dnew = ds * (1 - z) * (1 - new * new)
                dz = ds * (s - new) * z * (1 - z)
                dr = dnew * mn * r * (1 - r)
                dg = np.concatenate([dz, dr, dnew], axis=1)
                dm = np.concatenate([dz, dr, dnew * r], axis=1)
                np.add.at(grad["W" + side], inp[:a, t], dg)
                grad["U" + side] += s.T @ dm
                carry[:a] = ds * z + dm @ u.T
        return float(loss), grad

    def fit(self, by_lang: list[list[bytes]], seed: int = 5) -> BiGru:
        """Adam over balanced batches of windows; ``by_lang`` has the documents of each language's sample."""
        rng = np.random.default_rng(seed)
        joined = [b" ".join(docs) for docs in by_lang]
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        for step in range(1, STEPS + 1):
            langs = rng.integers(len(joined), size=BATCH)
            places = [int(rng.integers(max(1, len(joined[k]) - PIECE + 1))) for k in langs]
            _, grad = self.gradients([joined[k][p : p + PIECE] for k, p in zip(langs, places)], langs)
            rate = RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1)))
            for k, g in grad.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self


def sample(labelled: DataFrame) -> DataFrame:
    """A bounded sample of ``labelled (doc_id, text, lang)``: lang, h, piece; rows without text or lang are left out.

    Of each language, with repeated rows counted once, the SAMPLE_DOCS documents with the smallest hashes
    of id and text, and a piece of SAMPLE_CHARS characters at a place that the hash chooses.
    A language's cut is read off an approximate count of its documents, and doubled until it has enough or all, so no
    task ever sees all documents of one language.
    """
    some = labelled.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    some = some.withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.col("text")))
    share = F.col("h").cast("double") / F.lit(float(1 << 64)) + 0.5
    cuts = {r["lang"]: 3.0 * SAMPLE_DOCS / r["n"] for r in some.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect() if r["n"]}
    if not cuts:
        return some.select("lang", "h", F.col("text").alias("piece")).limit(0)
    while True:
        cut = F.element_at(F.map_from_arrays(F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts.values()))), F.col("lang"))
        below = some.where(share <= cut)
        held = below.select("lang", "h").distinct().groupBy("lang").agg(F.sort_array(F.collect_list("h")).alias("h")).collect()
        got = {r["lang"]: r["h"] for r in held}
        few = [k for k, c in cuts.items() if c < 1 and len(got.get(k, [])) < SAMPLE_DOCS]
        if not few:
            break
        cuts.update({k: 2 * cuts[k] for k in few})
    tops = {k: h[:SAMPLE_DOCS][-1] for k, h in got.items()}
    top = F.element_at(F.map_from_arrays(F.array(*map(F.lit, tops)), F.array(*map(F.lit, tops.values()))), F.col("lang"))
    place = F.pmod("h", F.greatest(F.lit(1), F.char_length("text") - F.lit(SAMPLE_CHARS) + 1).cast("long")).cast("int") + 1
    piece = F.substring("text", place, F.lit(SAMPLE_CHARS))
    return below.where(F.col("h") <= top).groupBy("lang", "h").agg(F.min(piece).alias("piece"))


def train(labelled: DataFrame) -> BiGru | None:
    """Fit a network to a sample of ``labelled (doc_id, text, lang)``; None where it has no letters.

    Every language with labelled text is learned. The driver holds SAMPLE_DOCS pieces of each.
    """
    by_lang: dict[str, list[bytes]] = {}
    for r in sample(labelled).orderBy("lang", "h").toLocalIterator():
        if has_letter(r["piece"]):
            by_lang.setdefault(r["lang"], []).append(stream(r["piece"]))
    langs = sorted(by_lang)
    return BiGru(langs).fit([by_lang[k] for k in langs]) if langs else None


def identify(docs: DataFrame, net: BiGru | None) -> DataFrame:
    """``docs`` (all columns kept) with lang_pred and score; only ``text`` is read.

    Whole texts are read. Null texts and texts without a letter are ``und`` with score 0, as is
    everything if there is no network. Equal texts get equal results; an empty table stays empty.
    """
    if net is None:
        return docs.withColumn("lang_pred", F.lit(UNDETERMINED)).withColumn("score", F.lit(0.0))
    schema = docs.drop("lang_pred", "score").withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b = b.reset_index(drop=True)
            lang, score = np.full(len(b), UNDETERMINED, object), np.zeros(len(b))
            held, rows, size = [], [], 0

            def flush() -> None:
                p = net.label(held)
                p = np.round(p / p.sum(axis=1, keepdims=True), 4)  # beyond that, sums depend on what runs side by side
                lang[rows] = np.array(net.langs, object)[p.argmax(axis=1)]
                score[rows] = p.max(axis=1)

            for i, t in enumerate(b["text"]):
                if has_letter(t):
                    held.append(stream(t))
                    rows.append(i)
                    size += len(t)
                    if size > AT_ONCE:
                        flush()
                        held, rows, size = [], [], 0
            if held:
                flush()
            yield b.assign(lang_pred=lang, score=np.minimum(score, 1.0))

    return common.map_in_pandas(docs.drop("lang_pred", "score"), run, schema)


def held_out() -> Column:
    """Whether a document is kept from training: crc32 of its id, modulo 5, is 0 (a null id: no)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from those not held out."""
    net = train(common.table(spark, sf_dir, "documents", "doc_id", "text", "lang").where(~held_out() & F.col("doc_id").isNotNull()))
    docs = common.table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", held_out())
    return identify(docs, net).select("doc_id", "held_out", "lang_pred", "score")
