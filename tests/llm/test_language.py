import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordforge.llm import language as la

SYLLABLES = {"aa": ["ba", "do", "ki", "lum", "pa"], "bb": ["sch", "ung", "ver", "ich", "ä"], "cc": ["ción", "que", "llo", "ñe", "ar"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = [(i, text(rng, lang := rng.choice(list(SYLLABLES)), rng.randrange(5, 120)), lang) for i in range(500)]
    return out + [(900, None, "aa"), (901, "", "bb"), (902, "12 34 !!", "cc"), (903, "quellon " * 30_000, None), (904, "x" * 100_000, None), (None, "schung verich", None), (5, "schung ver", None), (5, "schung ver", None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash")).repartition(3)


def net():
    rng = np.random.default_rng(0)
    n = la.BiGru(["a", "b", "c"])
    n.p = {k: rng.standard_normal(v.shape).astype(np.float32) for k, v in n.p.items()}
    return n


def brute(n, word):
    """The network, a byte and a row at a time."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    h = la.HIDDEN

    def side(w, seq):
        s, out = np.zeros(h), []
        for b in seq:
            g, m = n.p["W" + w][b], s @ n.p["U" + w]
            z, r = sig(g[:h] + m[:h]), sig(g[h : 2 * h] + m[h : 2 * h])
            s = (1 - z) * np.tanh(g[2 * h :] + r * m[2 * h :]) + z * s
            out.append(s)
        return out

    f, b = side("f", word), side("b", word[::-1])[::-1]
    out = []
    for x, y in zip(f, b):
        e = np.exp(np.concatenate([x, y]) @ n.p["V"] + n.p["c"])
        out.append(e / e.sum())
    return out


def in_windows(n, doc):
    """The sums that brute force gives over windows, of which the middle counts."""
    core, total = la.WINDOW - 2 * la.EDGE, np.zeros(len(n.langs))
    for at in range(0, len(doc), core):
        lo, hi = max(0, at - la.EDGE), min(len(doc), at + core + la.EDGE)
        each = brute(n, doc[lo:hi])
        total += sum(each[at - lo : min(at + core, len(doc)) - lo])
    return total


def test_labels_equal_brute_force(monkeypatch):
    rng = random.Random(2)
    n, docs = net(), [b"a", b"hello", b"", b"\xc3\xa9t\xc3\xa9", b"hi there"] + [bytes(rng.choice(b"abc de") for _ in range(k)) for k in (19, 20, 21, 33, 150)]
    for window, edge, side in ((256, 8, 1024), (20, 4, 3), (20, 0, 7)):
        monkeypatch.setattr(la, "WINDOW", window)
        monkeypatch.setattr(la, "EDGE", edge)
        monkeypatch.setattr(la, "SIDE", side)
        assert np.allclose(n.label(docs), [in_windows(n, d) for d in docs], atol=1e-3)


def test_gradients_equal_differences():
    n, words, langs = net(), [b"abc", b"d", b"cabba", b"ab"], np.array([0, 1, 2, 1])
    n.p = {k: (v * 0.3).astype(np.float64) for k, v in n.p.items()}
    _, grad = n.gradients(words, langs)
    rng = np.random.default_rng(1)
    for k, v in n.p.items():
        used = np.flatnonzero(np.abs(grad[k]).ravel() > 1e-5)
        for i in rng.choice(used, min(6, len(used)), replace=False):
            at, eps = np.unravel_index(i, v.shape), 1e-3
            v[at] += eps
            up = n.gradients(words, langs)[0]
            v[at] -= 2 * eps
            down = n.gradients(words, langs)[0]
            v[at] += eps
            assert abs((up - down) / (2 * eps) - grad[k][at]) < 2e-3 + 0.05 * abs(grad[k][at])


def test_stream_holds_every_position():
    assert la.stream("Ab " + "É" * 50 + "\t x\n") == ("ab " + "é" * 50 + " x").encode()


def test_query(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(la, "STEPS", 150)
    frame(spark, rows).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = la.op3_language(spark, f"{tmp_path}/a").collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    truth = {r[0]: r for r in rows}
    right = held = 0
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and truth[r.doc_id][2]:
            held += 1
            right += r.lang_pred == truth[r.doc_id][2]
    assert held > 50 and right >= 0.97 * held
    assert {r.lang_pred for r in got if r.doc_id == 903} == {"cc"} and {r.lang_pred for r in got if r.doc_id is None} == {"bb"}


def test_no_rows_and_no_labels(spark, rows, tmp_path):
    frame(spark, rows).limit(0).write.parquet(f"{tmp_path}/a/documents.parquet")
    assert la.op3_language(spark, f"{tmp_path}/a").collect() == []
    frame(spark, rows).withColumn("lang", F.lit(None).cast("string")).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert {r.lang_pred for r in la.op3_language(spark, f"{tmp_path}/b").collect()} == {"und"}


def test_sample_is_bounded_whole_and_repeatable(spark, rows, monkeypatch):
    monkeypatch.setattr(la, "SAMPLE_DOCS", 3)
    monkeypatch.setattr(la, "SAMPLE_CHARS", 40)
    many = [(None, "bado kilum", "aa")] * 300 + [r for r in rows if r[2]] + [(k, f"lumpa {k} " * 9000, "long") for k in range(950, 960)] + [(990, "only one", "rare")]
    got = [sorted(map(tuple, la.sample(frame(spark, many).repartition(k)).collect())) for k in (1, 4)]
    assert got[0] == got[1]
    per = {k: [r for r in got[0] if r[0] == k] for k in {r[2] for r in many}}
    assert {k: len(v) for k, v in per.items()} == {"aa": 3, "bb": 3, "cc": 3, "long": 3, "rare": 1}
    assert all(len(p) <= 40 for _, _, p in got[0])
    hashes = frame(spark, many).where("lang = 'bb' and text is not null").select(F.xxhash64(F.col("doc_id").cast("string"), F.col("text")).alias("h")).distinct().orderBy("h").limit(3)
    assert [r.h for r in hashes.collect()] == [h for _, h, _ in per["bb"]]


def test_every_language_is_learned(spark, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(la.BiGru, "fit", lambda self, by_lang: seen.append((self.langs, [len(x) for x in by_lang])) or self)
    many = [(i, "bado kilum", f"l{i:03}") for i in range(300)]
    assert len(la.train(frame(spark, many)).langs) == 300


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="needs the synthetic tables")
def test_held_out_accuracy_on_the_tables(spark):
    d = "/root/testdata/sf0.01"
    got = la.op3_language(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id")
    got = got.where("held_out and lang is not null and lang_pred <> 'und'").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok")).agg(F.avg("ok"), F.count("ok")).first()
    assert got[1] > 100 and got[0] >= 0.98
