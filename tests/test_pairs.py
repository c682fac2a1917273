"""Near-duplicate stems against all pairs, also where texts have few words."""

import random
import re
from collections import defaultdict
from difflib import SequenceMatcher

from recordforge.functions import patterns as P
from recordforge.operators import edits, pairs


def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    base = [" ".join(word() for _ in range(rng.choice([16, 30, 90]))) for _ in range(12)]
    base += ["x" * 120, "".join(rng.choice("abcdefgh") for _ in range(160)), "".join(rng.choice("漢字仮名交文章語言") for _ in range(90)), "ab " * 40]
    out = []
    for t in base:
        out += [t, t.upper(), t + "  "]
        for _ in range(6):
            s = list(t)
            for _ in range(rng.randrange(1, 2 + len(s) // 18)):
                i = rng.randrange(len(s))
                s[i : i + 1] = rng.choice([[], ["q"], [s[i], "z"]])
            out.append("".join(s))
    return out + ["short text", None, "", "y" * 79, "y" * 80, "y" * 80]


def brute(rows):
    norm = {i: " ".join((t or "").lower().split()) for i, t in rows}
    links = set()
    ids = [i for i, t in norm.items() if len(t) >= P.DUP_MIN_LEN]
    for i in ids:
        for j in ids:
            a, b = norm[i], norm[j]
            if i < j and max(len(a), len(b)) <= P.DUP_LEN_RATIO * min(len(a), len(b)):
                if SequenceMatcher(None, a[: P.DUP_PREFIX], b[: P.DUP_PREFIX]).ratio() >= P.DUP_RATIO:
                    links.add((i, j))
    return norm, links


def test_near_duplicates_equal_all_pairs(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame([("c", i, t) for i, t in rows], "chapter string, id long, text string").repartition(3)
    got = {(r.a, r.b): r.ratio for r in pairs.near_duplicates(df).collect()}
    norm, want = brute(rows)
    classes = defaultdict(list)
    for i, t in norm.items():
        if len(t) >= P.DUP_MIN_LEN:
            classes[t].append(i)
    rep = {i: c[0] for c in classes.values() for i in c}
    expect = {(min(rep[i], rep[j]), max(rep[i], rep[j])) for i, j in want if rep[i] != rep[j]} | {(rep[i], i) for i in rep if rep[i] != i}
    assert set(got) == expect and len(expect) > 100


def test_cross_search_finds_short_heads(spark):
    rng = random.Random(4)
    solutions = [(i, " ".join(rng.choice(["lens", "optic", "nerve", "a", "of", "the", "iris", "漢字文", "b."]) for _ in range(30))) for i in range(40)] + [(90, None), (91, "")]
    heads = [(0, "lens"), (1, "a"), (2, "漢"), (3, "nerve of the"), (4, "absent one"), (5, ""), (6, None), (7, "ns op"), (8, solutions[5][1][3:40]), (9, solutions[7][1]), (10, "  LENS   optic ")]
    f = spark.createDataFrame(heads, "frag int, text string")
    r = spark.createDataFrame(solutions, "q_no int, solution string")
    norm = lambda t: " ".join((t or "").lower().split())
    want = {}
    for k, h in heads:
        hit = [i for i, t in solutions if norm(h)[:120] and norm(h)[:120] in norm(t)]
        if hit:
            want[k] = min(hit)
    assert {x.frag: x.q_no for x in edits.cross_search(f, r).collect()} == want


def test_duplicate_text_flags_name_the_less_coherent(spark):
    from recordforge.operators import flags

    stem = "the optic nerve carries impulses from the retina to the brain and is covered by sheaths all along its way"
    rows = [("c", 1, stem, "the optic nerve is covered by sheaths"), ("c", 2, stem, "nothing alike"), ("c", 3, stem + ".", "the optic nerve carries impulses from the retina to the brain"), ("d", 4, stem, "x"), ("c", 5, "short", "x")]
    df = spark.createDataFrame(rows, "chapter string, id long, stem string, payload string")
    got = {(r.chapter, r.kind, r.q_no, r.detail) for r in flags.duplicate_texts(df).collect()}
    assert got == {("c", "duplicate_text", 2, "like 1"), ("c", "duplicate_text", 1, "like 3")}


def test_shared_segments_equal_all_pairs(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9)))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join(word() for _ in range(rng.randrange(40, 90))) + (" " + passage if i % 3 == 0 else "") + " " + " ".join(word() for _ in range(20))) for i in range(30)]
    rows += [(50, passage), (51, rows[1][1]), (52, " ".join(passage.split()[:30]) + " " + " ".join(word() for _ in range(60)))]
    df = spark.createDataFrame([("c", i, t) for i, t in rows], "chapter string, id long, text string").repartition(3)
    got = {(r.a, r.b): (r.common, r.longest, r.suspect) for r in pairs.shared_segments(df).collect()}
    want = {}
    for i, x in rows:
        for j, y in rows:
            if i >= j or min(len(x), len(y)) <= P.SEGMENT_TEXT_LEN:
                continue
            s, t = x.split(), y.split()
            runs = lambda w: {tuple(w[k : k + P.SEGMENT_N]) for k in range(len(w) - P.SEGMENT_N + 1)}
            common = len(runs(s) & runs(t))
            m = SequenceMatcher(None, s, t).find_longest_match(0, len(s), 0, len(t))
            longest = len(" ".join(s[m.a : m.a + m.size]))
            if common >= P.SEGMENT_MIN_SHINGLES and longest >= P.SEGMENT_MIN_CHARS:
                want[i, j] = (common, longest, i if len(x) > len(y) else j)
    assert got == want and len(want) > 20


def test_coherence_is_read_of_paired_records_only(spark):
    from recordforge.operators import flags

    stem = "a stem that is long enough to be compared with the other stems of its chapter, word by word"
    rows = spark.createDataFrame([(1, 1, stem, "stem long"), (1, 2, stem, ""), (1, 3, "short", "other")], "chapter int, id long, stem string, payload string")
    out = flags.duplicate_texts(rows)
    assert [(r.q_no, r.detail) for r in out.collect()] == [(2, "like 1")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert any("LeftSemi" in line and "id" in line for line in plan.splitlines() if "chapter" not in line)


def test_near_duplicates_shuffle_prefixes_not_runs(spark, monkeypatch):
    """Each text makes a few rows, also where parts are small, and parts lose no pair."""
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh ijkl") for _ in range(rng.choice([90, 110, 140, 380, 600]))) for _ in range(20)]
    rows = list(enumerate(t[:k] + "!" + t[k:] for t in base for k in range(0, 84, 7)))
    df = spark.createDataFrame([("c", i, t) for i, t in rows], "chapter string, id long, text string").repartition(3)
    _, want = brute(rows)
    for least, rows_a_text in ((1_024, 3), (16, 40)):
        monkeypatch.setattr(pairs, "LEAST_PART", least, raising=False)
        out = pairs.near_duplicates(df)
        assert {(r.a, r.b) for r in out.collect()} == want and len(want) > 800
        plan, made = out._jdf.queryExecution().executedPlan(), []
        todo = [plan]
        while todo:
            p = todo.pop()
            if p.nodeName() == "Generate":
                made.append(p.metrics().get("numOutputRows").get().value())
            todo += [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if "QueryStage" in p.nodeName() else []
            todo += [p.children().apply(i) for i in range(p.children().size())]
        assert made and max(made) <= rows_a_text * len(rows)


def test_near_duplicates_without_a_chapter(spark):
    """Records without a chapter are compared with each other, and with no chapter's."""
    from recordforge.operators import flags

    t = "".join(random.Random(8).choices("abcdefgh", k=150))
    rows = [(None, 1, t), (None, 2, t + "."), (None, 3, t.upper()), ("c", 4, t), ("", 5, t), ("", 6, "," + t)]
    df = spark.createDataFrame(rows, "chapter string, id long, text string")
    assert {(r.a, r.b) for r in pairs.near_duplicates(df).collect()} == {(1, 2), (1, 3), (5, 6)}
    out = flags.duplicate_texts(df.selectExpr("chapter", "id", "text stem", "'' payload"))
    assert {(r.chapter, r.q_no, r.detail) for r in out.collect()} == {(None, 2, "like 1"), (None, 3, "like 1"), ("", 6, "like 5")}


def test_near_duplicates_of_classes_in_either_order(spark):
    """From 200 characters on the matcher's second text has junk: only the copy that comes second links the shorter text with the longer."""
    short = "".join(random.Random(7).choices("abcd", k=199))
    long = "xy" + short
    assert SequenceMatcher(None, short, long).ratio() < P.DUP_RATIO <= SequenceMatcher(None, long, short).ratio()
    found = lambda rows: {(r.a, r.b) for r in pairs.near_duplicates(spark.createDataFrame([("c", *r) for r in rows], "chapter string, id long, text string")).collect()}
    assert found([(1, short), (2, long), (3, short)]) == {(1, 2), (1, 3)}
    assert found([(1, short), (2, long)]) == set()
    assert found([(1, short), (2, short), (3, long)]) == {(1, 2)}
    assert found([(1, long), (2, short)]) == {(1, 2)}


def test_cross_search_does_not_shuffle_all_runs(spark):
    """A few heads, of few words and of many, go to the bodies' runs: these are not sorted to meet them."""
    rows = [(i, f"the optic nerve number {i} carries impulses from the retina to the brain") for i in range(30)]
    r = spark.createDataFrame(rows, "q_no int, solution string").repartition(3)
    f = spark.createDataFrame([(1, "number 7 c"), (2, rows[9][1]), (3, "absent")], "frag int, text string").repartition(2)
    out = edits.cross_search(f, r)
    assert {x.frag: x.q_no for x in out.collect()} == {1: 7, 2: 9}
    assert not re.search(r"SortMergeJoin \[s#\d+L?\], \[s#\d+L?\], Inner", out._jdf.queryExecution().sparkPlan().toString())
