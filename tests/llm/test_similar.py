import random
from collections import defaultdict

import numpy as np
import pytest

from recordforge.llm import simhash


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    """Smallest index of each text's group, by all pairs."""
    sets, part = [shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) * 5 >= len(a | b) * 4:
                u, v = find(i), find(j)
                part[max(u, v)] = min(u, v)
    return [find(i) for i in range(len(texts))]


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    line = " ".join(word() for _ in range(30))
    out = [None, "", "one", "One", "one two three", line]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([8, 30, 120, 400]))]
        for _ in range(14):
            new = list(base)
            for _ in range(rng.randrange(1 + len(base) // 30)):
                new[rng.randrange(len(new))] = word()
            out.append(" ".join(new) + (" " + line if rng.random() < 0.3 else ""))
    return out + out[20:30]


@pytest.mark.parametrize(("crowd", "held"), [(512, 1 << 20), (8, 50)])
def test_groups_equal_all_pairs(spark, monkeypatch, crowd, held):
    monkeypatch.setattr(simhash, "CROWD", crowd)
    monkeypatch.setattr(simhash, "WIDE_TRIE", 16)
    monkeypatch.setattr(simhash, "HELD", held)
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    groups = defaultdict(set)
    for r in simhash.similar_groups(simhash.packed(df)).collect():
        groups[r.part].add(r.doc_id)
    want = defaultdict(set)
    for i, p in enumerate(brute(texts)):
        want[p].add(i)
    got = sorted(map(sorted, groups.values()))
    # no two texts are together that all pairs keep apart, and of the groups of all pairs hardly any is cut
    whole = {i: frozenset(g) for g in want.values() for i in g}
    assert all(len({whole[i] for i in g}) == 1 for g in got)
    assert len(got) - len(want) <= 0.03 * len(texts)
    assert sum(len(g) > 1 for g in got) >= 12


def test_recall_at_the_least_similarity():
    """Pairs just above the least similarity meet in a block and are within the budgets: nine of ten and more."""
    rng, hits, total = np.random.default_rng(3), 0, 0
    bits, blocks = simhash._forests(1 << 17)
    per = 64 // bits
    at = np.arange(blocks)
    word, shift, mask = simhash.WIDE + at // per, (at % per * bits).astype(np.uint64), np.uint64((1 << bits) - 1)
    for _ in range(300):
        n = int(rng.integers(40, 900))
        both, own = rng.integers(0, 1 << 63, n, dtype=np.uint64), n // 9
        a, b = (np.unique(np.concatenate([both, rng.integers(0, 1 << 63, own, dtype=np.uint64)])) for _ in range(2))
        if not simhash.similar(a, b):
            continue
        x, y = (simhash.wide_fingerprint(s, simhash.WIDE + -(-blocks // per)) for s in (a, b))
        far = np.bitwise_count(x ^ y)
        met = (((x[word] >> shift) & mask) == ((y[word] >> shift) & mask)).any()
        total += 1
        hits += bool(met and far[0] <= simhash.FIRST and far[: simhash.WIDE].sum() <= simhash.NEAR)
    assert total > 200 and hits >= 0.92 * total


def test_wide_fingerprint_equals_brute_force():
    rng = np.random.default_rng(4)
    for n in (1, 2, 255, 256, 700):
        s = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        got = simhash.wide_fingerprint(s, 3)
        for w in range(3):
            counts = [0] * 64
            for h in s.tolist():
                x = (h + (w + 1) * 0x9E3779B97F4A7C15) % 2**64
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
                x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
                x ^= x >> 31
                for b in range(64):
                    counts[b] += x >> b & 1
            assert int(got[w]) == sum(1 << b for b in range(64) if 2 * counts[b] > n)


def test_forest_is_minimal():
    rng = random.Random(6)
    for _ in range(20):
        n = rng.randrange(2, 30)
        links = [(rng.randrange(n), rng.randrange(n), rng.randrange(9)) for _ in range(rng.randrange(80))]
        u, v, d = (np.array(x, np.int64) for x in (zip(*links) if links else ((), (), ())))
        keep = simhash.forest(n, u, v, d)
        label = list(range(n))
        weight = count = 0
        for a, b, w in sorted(links, key=lambda x: x[2]):
            x, y = label[a], label[b]
            if x != y:
                label = [y if z == x else z for z in label]
                weight, count = weight + w, count + 1
        assert len(keep) == count and sum(int(d[k]) for k in keep) == weight


def test_first_of_groups_keeps_columns_of_any_name_and_chooses_alike(spark):
    names = ["n", "d", "h", "part", "rep_id", "times", "id2", "h2", "_h", "_row", "sid", "first", "wide"]
    rows = [(i // 2, "same text" if i < 4 else f"other text number {i // 2} of them all {i // 2}", *[f"{c}{i}" for c in names]) for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in names))
    for how in ({}, {"budget": 3}):
        got = [sorted(map(tuple, simhash.first_of_groups(df.repartition(k), **how).collect())) for k in (1, 3)]
        assert got[0] == got[1] == [rows[0], rows[4], rows[6]]
        assert simhash.first_of_groups(df, **how).columns == df.columns
        assert simhash.first_of_groups(df.limit(0), **how).collect() == []


def test_pipeline_stage_drops_copies_with_edits(spark):
    import corpus_pipeline as cp

    rng, rows = random.Random(8), []
    for k in range(60):
        base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        new = list(base)
        for at in rng.sample(range(300), 5):
            new[at] = f"x{rng.randrange(10**6)}"
        a, b = " ".join(base), " ".join(new)
        if len(shingles(a) & shingles(b)) * 5 >= len(shingles(a) | shingles(b)) * 4:
            rows += [(2 * k, a, "aa", "s", len(a)), (2 * k + 1, b, "aa", "s", len(b))]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [r.doc_id for r in cp.drop_near_duplicates(spark, df, "").collect()]
    assert len(rows) > 100 and {d for d in got if d % 2 == 0} == {r[0] for r in rows if r[0] % 2 == 0}
    assert sum(d % 2 for d in got) <= 0.08 * len(rows) / 2
