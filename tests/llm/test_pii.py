import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from recordforge.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10 == 0


def ok(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    return kind != "phone" or 8 <= len(d) <= 15


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if ok(k, m.group())]


TEXTS = [
    None,
    "",
    "no digits here",
    "a@b.c@d.e a@b.com_x@y.z x@y é@ü.de \U0001f600 mail me: j.doe+x@mail-1.example.co.uk.",
    "a@b.com-x@y.z, %@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 000001.02.3.255 1..2.3.4.5 999.1.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111112222 4111  1111",
    "+1 (017) 555-7713 +49 30 1234567. +1 + 12345678 +123456789012345678 ++44 20 7946 0958",
    "call 030 123 4567 or write to jane (at) example (dot) com",
    "7" * 20_000,
    "1 " * 5_000 + "x",
    "a" * 50_000 + "@b.c",
    "1.2.3.4 " * 700,
    "a." * 20_000 + "@" + "b." * 20_000 + "c",
]


def test_base_equals_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("a1.@+- 2(é") for _ in range(rng.randrange(60))) for _ in range(400)]
    texts += ["".join(rng.choice("12345 -.") for _ in range(40)) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("base", F.lit(1)).repartition(4)
    got = pii.spans(df.drop("base")).select("doc_id", "base", "found").collect()
    for r in got:
        assert [tuple(s) for s in r.base] == brute(texts[r.doc_id]), texts[r.doc_id][:80]
        assert {tuple(s) for s in r.base} <= {tuple(s) for s in r.found}


def test_trees_as_columns_equal_numpy(spark):
    trees = pii.models(spark)
    x = np.random.default_rng(3).integers(0, 20, (50, 16)).astype(float)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "i int, f array<double>")
    for t in trees.values():
        got = [r.p for r in df.select("i", t.column(F.col("f")).alias("p")).orderBy("i").collect()]
        assert np.allclose(got, t.predict(x))


def test_held_out_accuracy(spark):
    lines = pii.labelled_lines(seed=99, n=600)
    df = spark.createDataFrame(lines, "label string, text string").repartition(2)
    rows = pii.spans(df).select("label", "found", "base").collect()
    hit = sum(any(s.kind == r.label for s in r.found) for r in rows if r.label != "none")
    wrong = sum(bool(set(r.found) - set(r.base)) for r in rows if r.label == "none")
    assert hit >= 0.8 * sum(r.label != "none" for r in rows)
    assert wrong <= 0.02 * sum(r.label == "none" for r in rows)


def test_redaction(spark):
    rows = [(1, "mail a@b.com now", "x"), (2, "clean é text", "y"), (3, None, "z"), (4, "+49 30 1234567 é a@b.com", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    df = df.withColumnRenamed("found", "source")
    got = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert got == {1: "mail [EMAIL] now", 2: "clean é text", 3: None, 4: "[PHONE] é [EMAIL]"}


def test_query(spark, tmp_path):
    rows = [(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, "a@b.com", 5), (0, None, 5)]
    spark.createDataFrame(rows, "doc_id long, text string, base int").write.parquet(f"{tmp_path}/a/documents.parquet")
    got = pii.op6_pii(spark, f"{tmp_path}/a").collect()
    want = []
    for d, t, _ in rows:
        b = brute(t)
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
        want.append((d, *[sum(x[0] == k for x in b) for k in pii.KINDS], hashlib.sha256(line.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:6] for r in got))) == sorted(map(str, want))
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/b/documents.parquet")
    assert pii.op6_pii(spark, f"{tmp_path}/b").collect() == []


def test_every_written_out_email_is_a_candidate(spark):
    forms = [f"john{a}example{d}com" for a in (" (at) ", "[at]", " at ", "(at)", "@") for d in (" (dot) ", "[dot]", " dot ", ".")]
    lines = [t for k, t in pii.labelled_lines(seed=31, n=600) if k == "email"]
    df = spark.createDataFrame([(f"write to {x} now",) for x in forms] + [(t,) for t in lines], "text string")
    assert [r.text for r in df.where(F.size(pii.candidates("email", F.col("text"))) == 0).collect()] == []
    found = pii.spans(df.limit(len(forms))).select("text", "found").collect()
    assert {r.text for r in found if not any(s.kind == "email" for s in r.found)} == set()


def test_sweeps_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(pii, "CHUNK", 4)
    rng = random.Random(5)
    rows = []
    for i in range(60):
        base, more = [], []
        for out, count in ((base, rng.randrange(12)), (more, rng.randrange(1, 40))):
            for _ in range(count):
                at = rng.randrange(300)
                out.append((at, at + rng.randrange(3, 60 if out is base else 30)))
        rows.append((i, base, [(rng.randrange(5) / 5, a, b, rng.choice(pii.KINDS)) for a, b in more]))
    df = spark.createDataFrame(rows, "i int, base array<struct<start:int,end:int>>, more array<struct<p:double,start:int,end:int,kind:string>>")
    got = df.select("i", pii._apart(F.col("base"), F.col("more")).alias("free")).withColumn("best", pii._best(F.col("free"))).collect()
    over = lambda a, b: a[0] < b[1] and b[0] < a[1]
    for r in got:
        _, base, more = rows[r.i]
        free = [c for c in more if not any(over(c[1:3], b) for b in base)]
        assert sorted((c.p, c.start, c.end, c.kind) for c in r.free) == sorted(free)
        best = [c for c in free if not any(over(c[1:3], d[1:3]) and (d[0], -d[1]) > (c[0], -c[1]) or (over(c[1:3], d[1:3]) and d[:2] == c[:2] and d[3] < c[3]) for d in free)]
        assert sorted((c.p, c.start, c.end, c.kind) for c in r.best) == sorted(best)


#: Lines by hand, not from the generator: the span that should be found, or none.
HAND = [
    ("email", "Please write to maria.lopez (at) uni-koeln (dot) de for the slides."),
    ("email", "contact: webmaster [at] library [dot] org, weekdays only"),
    ("email", "You can reach me at tom.b(at)posteo.de any time"),
    ("email", "e-mail jsmith at cs dot stanford dot edu"),
    ("ip", "ssh from host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 was refused"),
    ("ip", "the server address fe80::1ff:fe23:4567:890a does not answer"),
    ("phone", "Tel: 030 123 4567, Mo-Fr"),
    ("phone", "For help phone (212) 555-0187 before noon"),
    ("phone", "mobile 0171-5550199 or office"),
    ("phone", "call 415-555-0132 today"),
    ("card", "my visa card 4111.1111.1111.1111 was charged twice"),
    ("none", "The meeting at noon. Everyone came."),
    ("none", "Published 2019-04-12, revised 14.05.2021 at 10:45:30."),
    ("none", "ISBN 978-3-16-148410-0 is out of print"),
    ("none", "we sold 12,345,678.90 units of version 2.14.3"),
    ("none", "she looked at her watch. Then she left"),
    ("none", "std::vector and chapter 3: 4: 5 of the book"),
    ("none", "order 1234567890123 shipped in 1999"),
    ("none", "the years 1914-1918 and 1939-1945"),
    ("none", "look at figure 3. dots mark the means"),
]


def test_lines_by_hand(spark):
    df = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(HAND)], "i int, label string, text string")
    rows = pii.spans(df).select("label", "text", "found", "likeliest").collect()
    lost = [(r.label, r.text, r.likeliest) for r in rows if r.label != "none" and not any(s.kind == r.label for s in r.found)]
    wrong = [(r.text, r.found) for r in rows if r.label == "none" and r.found]
    assert len(lost) <= 2 and not wrong, (lost, wrong)


def test_columns_of_any_name_are_kept(spark):
    names = ["base", "found", "_row", "_text", "_all", "_more", "_wide", "_caller", "_new", "proposed", "likeliest", "_base_email"]
    rows = [(1, "mail a@b.com now", *names), (1, "mail a@b.com now", *names), (2, None, *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    got = sorted(map(tuple, pii.redact(df).collect()), key=str)
    assert got == [(1, "mail [EMAIL] now", *names)] * 2 + [(2, None, *names)] and pii.redact(df).columns == df.columns
    more = pii.spans(df)
    assert set(more.columns) == set(df.columns) and more.where("_all = '_all'").count() == 3
    assert pii.redact(df.limit(0)).collect() == []
