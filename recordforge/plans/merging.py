"""Queries of the conflict-aware merge and its relatives, over inline cases with their stated results, and over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.operators import merging as M

from . import sql as S
from .records import table
from .registry import query

ITEMS = [
    (1, 1, 1, "Q", "Which nerve is it?", None, None), (1, 1, 2, "A", None, "B", None), (1, 1, 3, "A", None, "C", None), (1, 2, 1, "S", None, None, "Part of the"), (1, 2, 2, "S", "stem from S", None, "Part of the whole solution."),
    (1, None, 1, "Q", "no number", None, None), (1, 23, 1, "S", None, None, "foreign"), (1, 3, 1, "Q", "Explanation: prose", None, None), (1, 3, 2, "Q", "What is the lens made of?", "D", None), (1, 3, 3, "S", None, "D", "The lens is made of fibres."),
]
_ITEM = "chapter int, q_no int, seq int, pass string, stem string, answer string, solution string"
_KNOWN = [(1, 1), (1, 2), (1, 3)]
_MERGED = [(1, 1, "Which nerve is it?", "B", None, 1), (1, 2, None, None, "Part of the whole solution.", 0), (1, 3, "What is the lens made of?", "D", "The lens is made of fibres.", 1)]


@query("merge_records", f"WITH {S.values('t', 'chapter, q_no, stem, answer, solution, conflicts', _MERGED)} SELECT * FROM t")
def merge_records(spark, d):
    return M.merge(S.inline(spark, _ITEM, ITEMS), S.inline(spark, "chapter int, q_no int", _KNOWN))[0]


@query("merge_skipped", "SELECT * FROM (VALUES (1, NULL, 'no number'), (1, 23, 'foreign number')) t(chapter, q_no, reason)")
def merge_skipped(spark, d):
    return M.merge(S.inline(spark, _ITEM, ITEMS), S.inline(spark, "chapter int, q_no int", _KNOWN))[1].select("chapter", "q_no", "reason")


@query("scope_mask", "SELECT * FROM (VALUES (1, 'Q', 's', NULL, NULL), (2, 'A', NULL, 'a', NULL), (3, 'S', NULL, 'a', 'x')) t(id, pass, stem, answer, solution)")
def scope_mask(spark, d):
    return M.scope(S.inline(spark, "id int, pass string, stem string, answer string, solution string", [(i, p, "s", "a", "x") for i, p in enumerate("QAS", 1)]))


@query(
    "relink_claims",
    """SELECT DISTINCT l_orderkey AS chapter, l_linenumber AS q_no, l_partkey AS file FROM lineitem
WHERE l_returnflag IN ('A', 'R') AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)
  AND NOT EXISTS (SELECT 1 FROM lineitem k WHERE k.l_returnflag = 'N' AND k.l_orderkey = lineitem.l_orderkey AND k.l_linenumber = lineitem.l_linenumber AND k.l_partkey = lineitem.l_partkey)""",
)
def relink_claims(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("q_no"), F.col("l_partkey").alias("file"), "l_returnflag")
    claims = li.withColumn("outcome", F.when(F.col("l_returnflag") == "A", "claimed").when(F.col("l_returnflag") == "R", "shared").otherwise("refused"))
    done = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("chapter"))
    records = li.join(done, "chapter", "left_semi").select("chapter", "q_no").distinct()
    files = table(spark, d, "part").where("p_size > 25").select(F.col("p_partkey").alias("file"))
    return M.relink(claims, records, files, li.where("l_returnflag = 'N'").select("chapter", "q_no", "file"))


LABELS = [(1, "A", 10.0, 650.0), (1, "B", 300.0, 650.0), (1, "C", 10.0, 450.0), (1, "D", 300.0, 450.0)]
FIGURES = [(1, 1, 20.0, 600.0), (1, 2, 290.0, 600.0), (1, 3, 155.0, 400.0), (1, 4, 20.0, 700.0), (1, 5, 310.0, 300.0)]


@query("option_owner", "SELECT * FROM (VALUES (1, 1, 'A'), (1, 2, 'B'), (1, 3, NULL), (1, 4, NULL), (1, 5, 'D')) t(page, fig, letter)")
def option_owner(spark, d):
    return M.option_owner(S.inline(spark, "page int, fig int, x double, y double", FIGURES), S.inline(spark, "page int, letter string, x double, y double", LABELS))


RECTS = [(1, 17, 50.0, 600.0, 200.0, 60.0, 0.1), (1, 18, 50.0, 540.0, 200.0, 60.0, 0.1), (1, 19, 50.0, 480.0, 200.0, 60.0, 0.1), (1, 1, 0.0, 0.0, 600.0, 800.0, 1.0), (2, 5, 0.0, 500.0, 100.0, 50.0, 0.1), (2, 6, 0.0, 380.0, 100.0, 50.0, 0.1)]


@query("slice_groups", "SELECT * FROM (VALUES (1, 17, 17), (1, 18, 17), (1, 19, 17), (1, 1, 1), (2, 5, 5), (2, 6, 6)) t(page, id, lead)")
def slice_groups(spark, d):
    return M.slice_groups(S.inline(spark, "page int, id int, x double, y double, w double, h double, share double", RECTS))


HARVEST = [
    (1, 1, {"A": "It is the nerve", "B": "This is the lens", "C": "Incorrect here", "D": "x"}, "s"), (1, 2, {"A": "It is one", "B": "plain", "C": "other", "D": "last"}, "plain text"),
    (1, 3, {"A": "the canal of Schlemm", "B": "iris", "C": "lens", "D": "cornea"}, "own: the canal of Schlemm"), (1, 7, {"A": "p", "B": "q", "C": "r", "D": "s"}, "First line. The canal of Schlemm."),
]


@query("options_harvested", "SELECT * FROM (VALUES (1, 1, 3, 0), (1, 3, 0, 1)) t(chapter, q_no, commentary, corroborated)")
def options_harvested(spark, d):
    return M.harvested_options(S.inline(spark, "chapter int, q_no int, options map<string,string>, solution string", HARVEST))


STATES = [(1, "s", 4, "A", "x", False, False, False), (2, "s", 4, None, "x", False, False, False), (3, "s", 4, "A", "x", True, False, False), (4, "s", 4, "A", "x", False, True, False), (5, "s", 4, "A", "x", False, False, True), (6, None, 3, "A", "", True, False, False)]


@query(
    "qa_status",
    "SELECT * FROM (VALUES (1, 'READY', ''), (2, 'INCOMPLETE', 'missing_answer'), (3, 'REVIEW_NEEDED', 'model_only_image'), (4, 'REVIEW_NEEDED', 'gate_notice'), (5, 'REVIEW_NEEDED', 'answer_flip'), (6, 'INCOMPLETE', 'missing_stem,bad_options,missing_solution,model_only_image')) t(id, qa_status, qa_reasons)",
)
def qa_status(spark, d):
    df = S.inline(spark, "id int, stem string, options int, answer string, solution string, model_only_image boolean, gate_notice boolean, answer_flip boolean", STATES)
    return M.qa_status(df).select("id", "qa_status", "qa_reasons")


CONTEST = [(1, 1, 15, "the trochlear nerve supplies the superior oblique muscle"), (2, 1, 15, "short text"), (3, 1, 7, "the trochlear nerve supplies the superior oblique muscle"), (4, 1, 15, "aqueous humour leaves the eye by the canal of Schlemm")]
BODIES = [(1, 15, "the cornea and its layers", True), (1, 7, "trochlear nerve: the superior oblique muscle is what the nerve supplies", True), (1, 8, "aqueous humour leaves by the canal of Schlemm in the eye", False)]


@query("owner_contest", "SELECT * FROM (VALUES (1, 'veto', 7), (2, 'ok', NULL), (3, 'ok', NULL), (4, 'redirect', 8)) t(frag, verdict, better)")
def owner_contest(spark, d):
    return M.owner_contest(S.inline(spark, "frag int, chapter int, q_no int, text string", CONTEST), S.inline(spark, "chapter int, q_no int, text string, whole boolean", BODIES))
