import json

import pytest
from pyspark.sql import functions as F

from recordforge.sources import readers as R
from recordforge.sources import writers as W

SCHEMA = "id string, n int"


@pytest.fixture
def lines(tmp_path):
    p = tmp_path / "rows.jsonl"
    p.write_text('{"id": "a", "n": 1}\nnot json at all\n{"id": "b", "n": 2}\n')
    return str(p)


def test_four_tolerances(spark, lines, tmp_path):
    with pytest.raises(Exception):
        R.strict(spark, lines, SCHEMA).collect()
    kept = R.preserving(spark, lines, SCHEMA).collect()
    assert len(kept) == 3 and [r[R.BAD] for r in kept if r[R.BAD]] == ["not json at all"]
    assert sorted(r.id for r in R.skipping(spark, lines, SCHEMA).collect()) == ["a", "b"]
    for read in (R.strict, R.preserving, R.skipping, R.document):
        assert read(spark, str(tmp_path / "none.jsonl"), SCHEMA).count() == 0
    (tmp_path / "doc.json").write_text(json.dumps({"id": "x", "n": 3}, indent=1))
    assert R.document(spark, str(tmp_path / "doc.json"), SCHEMA).collect()[0].n == 3


def test_partitions_and_sniffing(spark, tmp_path):
    for s, c in (("S", "S-001"), ("S", "S-002"), ("T", "T-001")):
        (tmp_path / s / c).mkdir(parents=True, exist_ok=True)
        (tmp_path / s / c / "q.jsonl").write_text(f'\n{{"id": "{c}", "solution": 1}}\n')
    got = R.partitions(spark, str(tmp_path), "q.jsonl", "id string").where("id is not null").collect()
    assert sorted((r.subject, r.chapter_dir, r.id) for r in got) == [("S", "S-001", "S-001"), ("S", "S-002", "S-002"), ("T", "T-001", "T-001")]
    p = str(tmp_path / "S" / "S-001" / "q.jsonl")
    assert R.sniff(spark, [p], "id", "solution") == [p] and R.sniff(spark, [p], "answer") == []


def test_lines_fallback_and_images(spark):
    words = spark.createDataFrame([("d", 1, 5.0, 10.01, "world"), ("d", 1, 1.0, 10.0, "hello"), ("d", 1, 1.0, 20.0, "next")], "doc string, page int, x double, y double, word string")
    assert {(r.y, r.line) for r in R.positioned_lines(words).collect()} == {(10.0, "hello world"), (20.0, "next")}
    pages = spark.createDataFrame([("d", 1, "text"), ("d", 2, " "), ("d", 3, None)], "doc string, page int, text string")

    def ocr(doc, page):
        if page == 3:
            raise OSError
        return f"seen {page}"

    assert {(r.page, r.text, r.via) for r in R.with_fallback(pages, ocr).collect()} == {(1, "text", "text"), (2, "seen 2", "ocr"), (3, "", "ocr")}
    images = spark.createDataFrame([("d", 7, p, 0.9, "w") for p in range(6)] + [("d", 8, 1, 0.2, "a"), ("d", 9, 2, 0.2, "a"), ("d", 10, 3, 0.2, "b")], "doc string, object_id int, page int, share double, sha string")
    marks = R.watermarks(images)
    assert [r.object_id for r in marks.collect()] == [7]
    owned = spark.createDataFrame([("b",)], "sha string")
    assert [r.sha for r in R.own_images(images, marks, owned).collect()] == ["a"]


def test_links_and_refusals(spark):
    urls = [("https://drive.google.com/file/d/AbC_1/view", 1, "%PDF"), ("ftp://x/y", 1, "%PDF"), ("http://127.0.0.1/a", 1, "%PDF"), ("http://u@10.0.0.1:80/", 1, "%PDF"), ("https://e.org/a", 10**9, "%PDF"), ("https://e.org/a", 1, "<html"), ("https://e.org/a.pdf", 1, "%PDF-1.7")]
    df = spark.createDataFrame(urls, "url string, size long, head string")
    got = df.select(R.direct_link(F.col("url")).alias("d"), R.fetch_refusal(F.col("url"), F.col("size"), F.col("head")).alias("r")).collect()
    assert got[0].d == "https://drive.google.com/uc?export=download&id=AbC_1"
    assert [r.r for r in got] == [None, "scheme", "private host", "private host", "too large", "not a PDF", None]


def test_model_answers(spark):
    answers = [('[{"q":1}][{"q":2}]', 2), ('{"q":1}\n{"q":2}', 2), ('Here:\n```json\n[{"q":1}]\n```', 1), ('[{"q":1}] and more', None), ("", None), (None, None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(answers)], "i int, a string")
    got = [r.n if r.ok else None for r in df.select("i", F.size(R.model_rows(F.col("a"), "struct<q:int>")).alias("n"), R.model_rows(F.col("a"), "struct<q:int>").isNotNull().alias("ok")).orderBy("i").collect()]
    assert got == [n for _, n in answers]
    v = spark.createDataFrame([('x {"flag_genuine": false, "confidence": "high"}',), ('{"flag_genuine": true, "confidence": "sure"}',), ("none",)], "a string").select(R.verdict(F.col("a")).alias("v")).collect()
    assert [bool(r.v) for r in v] == [True, False, False]
    items = spark.createDataFrame([('{"q":1}',), ('{"_batch_meta":{"a":1}}',)], "item string")
    a, b = R.split_control(items)
    assert a.count() == 1 and b.count() == 1


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("1", "v1", 0, "c1"), ("1", "v2", 1, "c1"), ("2", "v1", 2, "c2"), (None, "x", 3, "c2")], "id string, v string, pos int, chapter string")
    W.unique_first(rows, str(tmp_path / "first"), "id", "pos")
    assert {(r.id, r.v) for r in spark.read.json(str(tmp_path / "first")).collect()} == {("1", "v1"), ("2", "v1")}
    assert {(r.id, r.v) for r in W.unique_last(rows.where("id is not null"), "id", "pos").collect()} == {("1", "v2"), ("2", "v1")}
    path = str(tmp_path / "parts")
    W.replace_partitions(rows, path, "chapter")
    W.replace_partitions(rows.where("chapter = 'c1' and pos = 1"), path, "chapter")
    assert sorted(r.pos for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    W.append(rows, str(tmp_path / "log"))
    W.append(rows, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 8
    W.split({"completeness": rows, "questions": rows}, str(tmp_path / "split"), "chapter")
    assert spark.read.parquet(str(tmp_path / "split" / "completeness")).count() == 4
    with pytest.raises(PermissionError):
        W.final({"q": rows}, rows, str(tmp_path / "final"))
    assert W.final({"q": rows}, rows.limit(0), str(tmp_path / "final")) == {"q": 4}
    inv = W.inventory(spark.createDataFrame([("a",), ("b",)], "path string"), spark.createDataFrame([("a", 5)], "path string, length int"))
    assert {(r.path, r.outcome) for r in inv.collect()} == {("a", "copied"), ("b", "missing")}
    flags = spark.createDataFrame([("S", "REVIEW", "q2", "d2"), ("S", "BLOCKER", "q9", "d9")], "subject string, tier string, q_id string, detail string")
    assert W.digest(flags).collect()[0].markdown == "# S\n- [BLOCKER] q9: d9\n- [REVIEW] q2: d2"
