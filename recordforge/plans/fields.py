"""Queries of field-level operators, over inline cases with their stated results, and over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.operators import fields as O

from . import sql as S
from .evidence import split_text
from .records import table
from .registry import query


def cases(name: str, columns: str, rows: list[tuple], types: dict[str, str] | None = None):
    """Register a query over inline rows whose result is stated."""
    return query(name, f"WITH {S.values('t', columns, rows, types)} SELECT * FROM t")


REC = "id int, stem string, options map<string,string>, answer string, solution string"
RECS = [(1, None, None, None, None), (2, None, None, None, "s"), (3, "s", None, None, None), (4, None, {"A": "x"}, None, None), (5, "s", {}, "A", "x")]


@cases("anchorless", "id, anchorless", [(1, True), (2, False), (3, False), (4, False), (5, False)])
def anchorless(spark, d):
    return S.inline(spark, REC, RECS).select("id", O.anchorless().alias("anchorless"))


@cases("available_passes", "id, passes", [(1, ""), (2, "S_PASS=solution"), (3, "Q_PASS=options"), (4, "Q_PASS=stem;A_PASS=answer")])
def available_passes(spark, d):
    df = S.inline(spark, "id int, stem string, options string, answer string, solution string", [(1, None, None, None, " "), (2, None, None, None, "s"), (3, "s", "o", None, None), (4, "s", None, "A", None)])
    return df.select("id", F.array_join(F.transform(F.map_entries(O.available_passes()), lambda e: F.concat_ws("=", e["key"], e["value"])), ";").alias("passes"))


@cases("orphan_view", "orphan, snippet, pages", [(1, "b", "2,5"), (2, None, "")])
def orphan_view(spark, d):
    df = S.inline(spark, "orphan int, stem string, options string, answer string, solution string, pages array<int>", [(1, " ", "b", "c", None, [5, 2, 5]), (2, None, None, None, None, [])])
    return O.orphan_view(df).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


@cases("window_pages", "id, pages", [(1, "12,13"), (2, "")])
def window_pages(spark, d):
    df = S.inline(spark, "id int, f array<string>", [(1, ["page-012.jpg", "page-013.png", "cover.jpg"]), (2, ["x"])])
    return df.select("id", F.array_join(O.page_numbers(F.col("f")).cast("array<string>"), ",").alias("pages"))


@cases("image_names", "id, names", [(1, "S/S-p12-3.webp,S/S-001-002_Q_01.webp"), (2, "")])
def image_names(spark, d):
    df = S.inline(spark, "id int, d string", [(1, "lost S/S-p12-3.webp and S/S-001-002_Q_01.webp here"), (2, None)])
    return df.select("id", F.array_join(O.image_names(F.col("d")), ",").alias("names"))


@cases("pick_pages", "id, pages", [(1, "3,4"), (2, "7"), (3, "")])
def pick_pages(spark, d):
    df = S.inline(spark, "id int, a array<int>, b array<int>", [(1, [3, 4, 5], [9]), (2, [], [7]), (3, [], None)])
    return df.select("id", F.array_join(O.pick_pages(F.col("a"), F.col("b")).cast("array<string>"), ",").alias("pages"))


@query("payload", "SELECT doc_id, CAST(least(length(CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END), 700) AS INT) AS stem, CAST(least(length(CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END), 1200) AS INT) AS solution FROM documents")
def payload(spark, d):
    df = split_text(table(spark, d, "documents")).select("doc_id", "stem", F.array(F.lit("x")).alias("options"), "solution", F.lit("").alias("detail"))
    return O.payload(df).select("doc_id", F.char_length("stem").alias("stem"), F.char_length("solution").alias("solution"))


@cases("option_path", "before, after", [("y", "z")])
def option_path(spark, d):
    df = S.inline(spark, "options array<struct<id:string,text:string>>", [([("A", "x"), ("B", "y")],)])
    return df.select(O.get_option("B").alias("before"), O.set_option("B", F.lit("z")).alias("options")).select("before", O.get_option("B").alias("after"))


@cases("option_letters", "id, letters", [(1, "AC"), (2, "")])
def option_letters(spark, d):
    df = S.inline(spark, "id int, s string", [(1, "Option A: x\nsee Option B\n  option c. y"), (2, None)])
    return df.select("id", F.array_join(O.option_letters(F.col("s")), "").alias("letters"))


@cases("evidence_field", "id, value", [(1, "s"), (2, "q"), (3, "o"), (4, "A"), (5, None)])
def evidence_field(spark, d):
    rows = [(1, "q", "o", "A", "s"), (2, "q", "o", "A", " "), (3, None, "o", "A", ""), (4, None, "", "A", None), (5, None, None, None, None)]
    return S.inline(spark, "id int, stem string, options string, answer string, solution string", rows).select("id", O.evidence_field().alias("value"))


@cases("quota_errors", "id, kind", [(1, "day"), (2, "burst"), (3, None)])
def quota_errors(spark, d):
    return S.inline(spark, "id int, m string", [(1, "429 GenerateRequestsPerDay limit"), (2, "429 Too many requests"), (3, "timeout")]).select("id", O.quota_error(F.col("m")).alias("kind"))


@cases("repaired_json", "id, a", [(1, 1), (2, 2), (3, None)])
def repaired_json(spark, d):
    df = S.inline(spark, "id int, s string", [(1, '{"a": 1}'), (2, "{'a': 2}"), (3, "x")])
    return df.select("id", O.repaired_json(F.col("s"), "a int")["a"].alias("a"))


@cases("export_gate", "q_no, kind", [(1, "missing_answer"), (1, "broken_asset_ref"), (2, "missing_stem"), (2, "missing_answer"), (2, "missing_solution"), (2, "bad_options"), (None, "orphan_unresolved")])
def export_gate(spark, d):
    four = ["a", "b", "c", "d"]
    rec = S.inline(spark, "q_no int, stem string, options array<string>, answer string, solution string, broken int", [(1, "s", four, None, "x", 1), (2, None, None, None, "", 0), (3, "s", four, "A", "x", 0)])
    return O.export_gate(rec, S.inline(spark, "value string", [("text",), (" ",), (None,)]))


@cases("toc_scan", "book, page, no, title, start", [(1, 1, 1, "First", 5), (1, 9, 2, "Second one", 20), (2, 3, 1, "Only", 4)])
def toc_scan(spark, d):
    pages = [(1, p, {1: "Contents\n1. First ..... 5", 9: "2 Second one  20", 30: "3 Late 99"}.get(p, "")) for p in range(1, 45)] + [(2, p, "1) Only 4" if p == 3 else None) for p in range(1, 20)]
    return O.toc_scan(S.inline(spark, "book int, page int, text string", pages))


@cases("auto_resolved", "flag_key", [("k1",)])
def auto_resolved(spark, d):
    flags = [("k1", "lost S/S-p1-1.webp and S/S-p1-2.webp"), ("k2", "S/S-p1-1.webp, S/S-p9-9.webp"), ("k3", "none")]
    return O.auto_resolved(S.inline(spark, "flag_key string, detail string", flags), S.inline(spark, "file string", [("S/S-p1-1.webp",), ("S/S-p1-2.webp",)]))


@cases("false_figures", "flag_key", [("k1",), ("k3",)])
def false_figures(spark, d):
    images = [("d", 1, True, 90_000), ("d", 2, False, 100), ("d", 3, False, 90_000)]
    flags = [("k1", "d", [1, 2]), ("k2", "d", [2, 3]), ("k3", "d", [9])]
    return O.false_figures(S.inline(spark, "flag_key string, doc string, pages array<int>", flags), S.inline(spark, "doc string, page int, watermark boolean, pixels int", images))


@cases("image_aliases", "name, final, q_id", [("t1", "f1", "q1"), ("f2", "f2", "q2"), ("zz", "zz", None)])
def image_aliases(spark, d):
    ledger = S.inline(spark, "file string, final_file string", [("t1", "f1")])
    return O.aliases(S.inline(spark, "name string", [("t1",), ("f2",), ("zz",)]), ledger, S.inline(spark, "file string, q_id string", [("f1", "q1"), ("f2", "q2")]))


@cases("chapter_patches", "chapter, id, value, change", [("a", 1, "one", "kept"), ("a", 2, "two", "filled"), ("a", 9, "nine", "inserted"), ("b", 1, None, "kept")])
def chapter_patches(spark, d):
    rows = [("a", 1, "one"), ("a", 2, " "), ("a", 3, "dup"), ("b", 1, None)]
    patches = [("a", 1, "fill", "x"), ("a", 2, "fill", "two"), ("a", 3, "delete", None), ("a", 3, "insert", "back"), ("a", 9, "insert", "nine"), ("b", 1, "fill", "y")]
    return O.apply_patches(S.inline(spark, "chapter string, id int, value string", rows), S.inline(spark, "chapter string, id int, action string, value string", patches), S.inline(spark, "chapter string, ok boolean", [("a", True), ("b", False)]))


@cases("carry_owner", "chapter, kind, q_no", [(1, "solution", 9), (2, "question", 4)])
def carry_owner(spark, d):
    return O.carry_owner(S.inline(spark, "chapter int, kind string, q_no int, ending_page int", [(1, "question", 8, 482), (1, "solution", 9, 489), (2, "solution", 3, 7), (2, "question", 4, 7)]))


@cases("zip_skip", "path, skipped", [("_archive/x", True), ("a/_archive/x", True), ("a.bak-1", True), ("out.zip", True), ("data/q.jsonl", False)])
def zip_skip(spark, d):
    return S.inline(spark, "path string", [("_archive/x",), ("a/_archive/x",), ("a.bak-1",), ("out.zip",), ("data/q.jsonl",)]).select("path", O.zip_skipped(F.col("path")).alias("skipped"))


@query(
    "join_triplet",
    """SELECT o_orderkey AS q_id, o_orderstatus AS answer, count(*) AS solutions FROM orders JOIN customer ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL""",
)
def join_triplet(spark, d):
    """Questions, answers and solutions joined on their common key."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("q_id")).agg(F.count("*").alias("solutions"))
    return o.join(c, "o_custkey").select(F.col("o_orderkey").alias("q_id"), F.col("o_orderstatus").alias("answer")).join(li, "q_id")


@query("queue_counts", "SELECT o_orderpriority AS chapter, count(*) FILTER (o_orderstatus = 'O') AS open, count(*) FILTER (o_orderstatus = 'F') AS resolved, count(*) FILTER (o_orderstatus = 'P') AS auto FROM orders GROUP BY 1")
def queue_counts(spark, d):
    n = lambda k, name: F.count_if(F.col("o_orderstatus") == k).alias(name)
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("chapter")).agg(n("O", "open"), n("F", "resolved"), n("P", "auto"))


@query("pass_provenance", "SELECT role AS pass, count(DISTINCT (conv_id, turn)) AS records FROM conversations GROUP BY 1")
def pass_provenance(spark, d):
    return table(spark, d, "conversations").groupBy(F.col("role").alias("pass")).agg(F.count_distinct("conv_id", "turn").alias("records"))


@query(
    "summary_rollup",
    "SELECT o_orderpriority AS subject, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS passed FROM orders GROUP BY ROLLUP (o_orderpriority)",
)
def summary_rollup(spark, d):
    return table(spark, d, "orders").rollup(F.col("o_orderpriority").alias("subject")).agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("passed"))
