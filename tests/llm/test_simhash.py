import random

import numpy as np
import xxhash

from recordforge.llm import common, simhash


def brute_fp(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fp):
    label = list(range(len(fp)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(fp)):
        for j in range(i):
            if (fp[i] ^ fp[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fp))]


def near(rng, n, centres=20, flips=6):
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set(base)
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randrange(flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_fingerprint_equals_brute_force():
    rng = random.Random(1)
    texts = [None, "", " \t", "One", "one two three", "A b c d e f g", "É É é \x85 x y", "w " * 200_000]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60))) for _ in range(60)]
    for t in texts:
        assert simhash.text_fingerprint(t, 4) == brute_fp(t, 4)


def test_trie_equals_brute_force(monkeypatch):
    rng = random.Random(2)
    for front in (1 << 17, 64):
        monkeypatch.setattr(simhash, "FRONT", front)
        fp = near(rng, 300)
        arr = np.array(fp, np.uint64)
        got = simhash.trie_links(arr, np.array([[0, 300, 0, 300]]), 4)
        assert got.tolist() == brute_components(fp)


def test_links_equal_brute_force_and_crowds_are_dealt_out(spark, monkeypatch):
    rng = random.Random(3)
    fp = near(rng, 900, centres=9, flips=8)
    want = brute_components(fp)
    for crowd in (512, 40):
        monkeypatch.setattr(simhash, "CROWD", crowd)
        df = spark.createDataFrame([(simhash._signed(x),) for x in fp], "fp long")
        parts = {r.node: r.component for r in common.components(simhash.links(df)).collect()}
        got = [parts.get(simhash._signed(x), simhash._signed(x)) for x in fp]
        same = {}
        assert all(same.setdefault(g, w) == w for g, w in zip(got, want)) and len(set(got)) == len(set(want))


def test_more_blocks_for_more_fingerprints():
    for n in (10, 1 << 22, 1 << 40):
        masks, _ = simhash._blocks(n, 4)
        rng = random.Random(n)
        for _ in range(500):
            x = 0
            for b in rng.sample(range(64), 4):
                x |= 1 << b
            assert any(not x & m for m in masks)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    base = [" ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(400)) for _ in range(8)]
    rows = [(i, rng.choice(base) + rng.choice([" tail", " other end", "", " X"]), "s") for i in range(150)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "one", "s"), (202, "one", "s"), (None, "one", "s"), (203, "a" * 100_000, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    df.repartition(3).write.parquet(f"{tmp_path}/a/documents.parquet")
    got = simhash.op10_simhash(spark, f"{tmp_path}/a").collect()
    fp = [brute_fp(t, 4) for _, t, _ in rows]
    uniq = sorted(set(fp))
    part = dict(zip(uniq, brute_components(uniq)))
    least = {}
    for (d, _, _), f in zip(rows, fp):
        if d is not None:
            least[part[f]] = min(d, least.get(part[f], d))
    want = [(d, f"{f:016x}", least[part[f]]) for (d, _, _), f in zip(rows, fp)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    df.limit(0).write.parquet(f"{tmp_path}/b/documents.parquet")
    assert simhash.op10_simhash(spark, f"{tmp_path}/b").collect() == []
