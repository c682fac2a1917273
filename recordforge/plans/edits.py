"""Queries of edits and guards, over inline cases with their stated results, and over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.operators import edits as E
from recordforge.operators import ownership as O

from . import sql as S
from .evidence import REST, split_text
from .fields import cases
from .records import _BL, table
from .registry import query

OWN = [(1, 1, {"A": "optic nerve", "B": "lens"}, "The optic nerve.\nIt carries signals."), (1, 2, {"A": "x", "B": "y"}, "Second text line here.\nMore.")]


@cases("foreign_fragments", "frag, reason", [(1, "option label"), (2, "other header"), (3, "sibling's line")])
def foreign_fragments(spark, d):
    frags = [(1, 1, 1, "Option A: the zonules"), (2, 1, 1, "text Solution to Question 9: x"), (3, 1, 1, "Second text  line here.\nx"), (4, 1, 1, "Option A: optic nerve fibres"), (5, 1, 1, None)]
    return E.foreign(S.inline(spark, "frag int, chapter int, q_no int, text string", frags), S.inline(spark, "chapter int, q_no int, options map<string,string>, solution string", OWN))


@cases("clip_solutions", "response, q_no, solution", [(1, 1, "First."), (1, 2, "Second."), (2, 3, "Keep Solution to Question 9: all"), (2, 4, "Solution to Question 4:")])
def clip_solutions(spark, d):
    rows = [(1, 1, "First. Solution to Question 2: second"), (1, 2, "Solution to Question 2: Second."), (2, 3, "Keep Solution to Question 9: all"), (2, 4, "Solution to Question 4:")]
    return E.clip(S.inline(spark, "response int, q_no int, solution string", rows))


@cases("cross_search", "frag, q_no", [(1, 2)])
def cross_search(spark, d):
    rec = S.inline(spark, "q_no int, solution string", [(1, "nothing of the kind is here at all"), (2, "Before. The lens  is held by fine zonules today."), (3, "the lens is held by fine zonules today too")])
    return E.cross_search(S.inline(spark, "frag int, text string", [(1, "The lens is held by fine zonules"), (2, "no such words anywhere in here")]), rec)


@query("nearest_empty", f"SELECT source AS chapter, doc_id AS q_no, last_value(CASE WHEN {_BL(REST)} THEN doc_id END IGNORE NULLS) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS empty_before FROM documents")
def nearest_empty(spark, d):
    return E.nearest_empty(split_text(table(spark, d, "documents")).select(F.col("source").alias("chapter"), F.col("doc_id").alias("q_no"), "solution"))


@cases("edit_guard", "id, error", [(1, None), (2, "letter"), (3, "answer"), (4, "uneven columns"), (5, "field"), (6, None)])
def edit_guard(spark, d):
    rows = [(1, "option", "B", "x"), (2, "option", "Z", "x"), (3, "answer", None, "F"), (4, "table", None, "| a | b |\n|---|---|\n| 1 |"), (5, "title", None, "x"), (6, "table", None, "| a |\n|---|\n| 1 |")]
    return S.inline(spark, "id int, field string, letter string, value string", rows).select("id", E.edit_error(F.col("field"), F.col("letter"), F.col("value")).alias("error"))


@cases("verified_edits", "id, stem, answer, solution, verified", [(1, "new", "B", "s", True), (2, "stem", None, "s2", True)])
def verified_edits(spark, d):
    rows = S.inline(spark, "id int, stem string, answer string, solution string", [(1, "old", "A", "s"), (2, "stem", "C", "s2")])
    return E.apply_edits(rows, S.inline(spark, "pos int, id int, field string, value string", [(1, 1, "stem", "mid"), (2, 1, "stem", "new"), (3, 1, "answer", "B"), (4, 2, "answer", None)]))


@cases("image_operations", "op_id, error", [(1, None), (2, "shared"), (3, "not the owner"), (4, "other chapter"), (5, "operation"), (6, None)])
def image_operations(spark, d):
    ops = [(1, "move", "a", "c1", "q1", "q2", "c1"), (2, "detach", "s", "c1", "q1", None, None), (3, "detach", "a", "c1", "q9", None, None), (4, "move", "a", "c1", "q1", "q3", "c2"), (5, "burn", "a", "c1", "q1", None, None), (6, "attach", "new", "c1", None, "q1", "c1")]
    return E.image_op_error(S.inline(spark, "op_id int, op string, file string, chapter string, from_id string, to_id string, to_chapter string", ops), S.inline(spark, "file string, q_id string", [("a", "q1"), ("s", "q1"), ("s", "q2")]))


@cases("merge_items", "id, field, value", [(1, "stem", "v"), (2, "answer", "v"), (3, "solution", "v"), (4, "options", "v"), (5, None, None)])
def merge_items(spark, d):
    kinds = ["empty_question", "missing_answer", "truncated_solution", "bad_options", "numbering_gap"]
    return E.merge_item(S.inline(spark, "id int, kind string, value string", [(i, k, "v") for i, k in enumerate(kinds, 1)]))


@cases("table_html", "id, html", [(1, "<table><tr><th>a</th><th>b</th></tr><tr><td>1 &lt; 2</td><td>x &amp; y</td></tr></table>")])
def table_html(spark, d):
    return S.inline(spark, "id int, md string", [(1, "| a | b |\n|---|---|\n| 1 < 2 | x & y |")]).select("id", E.to_html(F.col("md")).alias("html"))


@cases("image_caps", "id, cap", [(1, 3), (2, 2), (3, 5), (4, 8), (5, 6)])
def image_caps(spark, d):
    rows = [(1, "question", None), (2, "solution", 1), (3, "question", 5), (4, "question", 99), (5, "solution", 99)]
    return S.inline(spark, "id int, side string, n int", rows).select("id", E.image_cap(F.col("side"), F.col("n")).alias("cap"))


@query(
    "rank_claims",
    """WITH a AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem WHERE l_returnflag = 'R'),
b AS (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) AS i FROM lineitem WHERE l_returnflag = 'A')
SELECT a.l_orderkey, a.i, a.l_partkey, b.l_suppkey FROM a JOIN b USING (l_orderkey, i)""",
)
def rank_claims(spark, d):
    """Figures to blocks one to one, in order, as far as both go."""
    from pyspark.sql import Window

    li = table(spark, d, "lineitem")
    rank = lambda f, *o: F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*o))
    a = li.where("l_returnflag = 'R'").select("l_orderkey", "l_partkey", rank(0, "l_linenumber", "l_partkey", "l_suppkey").alias("i"))
    b = li.where("l_returnflag = 'A'").select("l_orderkey", "l_suppkey", rank(0, "l_linenumber", "l_suppkey", "l_partkey").alias("i"))
    return a.join(b, ["l_orderkey", "i"])


@query(
    "chapter_for_page",
    """WITH r AS (SELECT o_custkey AS chapter, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders WHERE o_custkey <= 40 GROUP BY 1)
SELECT p_partkey AS page, min(chapter) AS chapter FROM part JOIN r ON p_partkey BETWEEN lo AND hi GROUP BY 1""",
)
def chapter_for_page(spark, d):
    """The first chapter whose own pages span a page."""
    r = table(spark, d, "orders").where("o_custkey <= 40").groupBy(F.col("o_custkey").alias("chapter")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("page"))
    return O.in_range(p, r, "page", "lo", "hi", 512).groupBy("page").agg(F.min("chapter").alias("chapter"))


@query("chapter_for_every_page")
def chapter_for_every_page(spark, d):
    """The first of all chapters whose own pages span a page."""
    r = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("chapter")).agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("page"))
    return O.first_in_range(p, r, "page", "lo", "hi", "chapter")
