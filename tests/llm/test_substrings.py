import random
from collections import Counter

import numpy as np
import pytest

from recordforge.llm import substrings


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(map(str, out))


def corpus(seed, n=60, vocab=40, lines=25):
    rng = random.Random(seed)
    passages = [" ".join(f"w{rng.randrange(vocab)}" for _ in range(rng.randrange(5, 60))) for _ in range(lines)]
    rows = []
    for i in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randrange(30))) for _ in range(rng.randrange(9))]
        rows.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(parts)))
    rows += [(100, None), (101, ""), (102, " \n"), (103, "a " * 300), (105, "x y " * 200), (106, "p q r a " * 90), (None, rows[3][1]), (3, rows[3][1]), (104, "é\x85à " * 50)]
    return rows


@pytest.mark.parametrize("window", [35, 10, 3])
def test_equals_brute_force(spark, window, monkeypatch):
    for seed, batch, stretch in ((1, 1 << 20, 1 << 17), (2, 500, 64)):
        monkeypatch.setattr(substrings, "BATCH", batch)
        monkeypatch.setattr(substrings, "STRETCH", stretch)
        rows = corpus(seed)
        df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, k1 int").repartition(3)
        got = substrings.dedup(df, window).collect()
        assert sorted(str((r.doc_id, r.n_words, r.n_removed, r.kept)) for r in got) == brute(rows, window)
        for r in got:
            assert sum(b - a for a, b in r.removed) == r.n_removed
            assert all(x[1] < y[0] for x, y in zip(r.removed, r.removed[1:]))


def test_runs_hold_every_window_once():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abc") for _ in range(n)).encode() for n in (0, 3, 10, 11, 400, 0, 12, 9)]
    got = Counter()
    for d, _, _, _, s, e in substrings.runs(texts, 10):
        for x, a, b in zip(d, s, e):
            got.update((int(x), i) for i in range(a, b + 1))
    assert got == Counter((k, i) for k, t in enumerate(texts) for i in range(len(t.split()) - 9))


def test_hash_of_a_stretch_does_not_depend_on_its_place():
    h = np.arange(1000, dtype=np.uint64) % np.uint64(10)
    r = substrings.Rolling(h, substrings._POWERS[1])
    k = np.arange(0, 900, 10)
    assert len(set(r.of(k, k + 35).tolist())) == 1 and len(set(r.of(k[:50] // 10, k[:50] // 10 + 35).tolist())) == 10


def test_empty_table(spark):
    assert substrings.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
