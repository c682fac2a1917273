import bisect
import hashlib
import random
import unicodedata

import xxhash
from pyspark.sql import functions as F

from recordforge.llm import fingerprints as fp

ROWS = [
    (1, "Hello  World"),
    (2, "hello\tworld "),
    (3, "HELLO WORLD"),
    (4, "Café Straße ﬁn"),
    (5, "café STRASSE fin"),
    (6, None),
    (7, ""),
    (8, "x" * 200_000),
    (9, "odd"),
    (9, "odd"),
    (None, "no id"),
    (10, "   \n"),
    (11, "\U0001f600\U0001f600aé"),
]


def canon(t):
    f = lambda s: unicodedata.normalize("NFKC", s)
    return " ".join(f(f(t or "").casefold()).split())


def digest(t):
    b = canon(t).encode()
    first = xxhash.xxh64_intdigest(b, 42)
    salt = xxhash.xxh64_intdigest(fp.SALT.encode(), 42)
    return f"{first:016x}{xxhash.xxh64_intdigest(b, salt):016x}"


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumn("fingerprint", F.lit("clash"))


def test_digest_equals_brute_force(spark):
    got = frame(spark, ROWS).select("doc_id", "text", fp.fingerprint(fp.canonical(F.col("text"))).alias("f")).collect()
    assert sorted((r.f, r.text or "") for r in got) == sorted((digest(t), t or "") for _, t in ROWS)


def test_groups(spark):
    got = {(r.doc_id, r.class_id) for r in fp.exact_groups(frame(spark, ROWS)).collect()}
    assert {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (6, 6), (7, 6), (10, 6), (8, 8), (9, 9), (None, None), (11, 11)} == got
    assert fp.exact_groups(frame(spark, ROWS).limit(0)).count() == 0


def test_equal_digests_of_different_texts_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fp, "fingerprint", lambda canon: F.substring(canon, 1, 1))
    rows = [(1, "abc"), (2, "abd"), (3, "ABC"), (4, "abd"), (5, "abe"), (6, "b"), (None, "abe")]
    got = {(r.doc_id, r.class_id, r.class_size) for r in fp.exact_groups(frame(spark, rows)).collect()}
    assert got == {(1, 1, 2), (3, 1, 2), (2, 2, 2), (4, 2, 2), (5, 5, 2), (None, 5, 2), (6, 6, 1)}


def test_large_classes_and_small_ones_meet_their_rows(spark, monkeypatch):
    monkeypatch.setattr(fp, "HOT", 3)  # only the first class holds more than a third of the rows
    rows = [(i, "Same  text") for i in range(40)] + [(100 + i, f"other {i // 2}") for i in range(40)]
    got = {r.doc_id: (r.class_id, r.class_size) for r in fp.exact_groups(frame(spark, rows)).collect()}
    assert got == {i: (0, 40) for i in range(40)} | {100 + i: (100 + i // 2 * 2, 2) for i in range(40)}


def test_place_equals_bisection(spark):
    rng = random.Random(1)
    for size in (0, 1, 2, 7, 100, 331):
        cuts = sorted(rng.sample(range(1000), size))
        df = spark.createDataFrame([(k,) for k in range(0, 1000, 7)], "k long")
        assert all(r.at == bisect.bisect_right(cuts, r.k) for r in df.select("k", fp._place(cuts, F.col("k")).alias("at")).collect())


def run(spark, tmp_path, rows):
    path = str(tmp_path / "in")
    frame(spark, rows).repartition(3).write.mode("overwrite").parquet(path + "/documents.parquet")
    return fp.op1_fingerprint(spark, path).collect()


def brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 2
        e = t[: len(t) - cut] + nxt[:cut]
        mates = [x for x, y in rows if canon(y) == canon(t)]
        known = [x for x in mates if x is not None]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), digest(t), digest(e), float(canon(t) == canon(e)), float(canon(t) == canon(nxt)), min(known) if known else None, len(mates)))
    return out


def test_query_equals_brute_force(spark, tmp_path):
    key = lambda r: (r[0] is not None, r)
    for rows in (ROWS, ROWS[:1], [(i, f"text {i % 7} " * (i % 40)) for i in range(400)]):
        got = [tuple(r) for r in run(spark, tmp_path, rows)]
        assert sorted(map(str, got)) == sorted(map(str, brute(rows)))


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
