"""Queries of tables, anchors, healing and fragments; most over inline cases, since the driver's tables have none."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X
from recordforge.operators import anchors as A
from recordforge.operators import healing as H
from recordforge.operators import ownership as O

from . import sql as S
from .records import table
from .registry import query

PIPED = r"regexp_matches(x, '^\s*\|.*\|\s*$')"


@query(
    "table_rows",
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents WHERE strpos(text, '|') > 0)
SELECT doc_id, count(*) FILTER (strpos(x, '|') > 0 AND strpos(x, '---') = 0) - 1 AS body FROM l GROUP BY 1""",
)
def table_rows(spark, d):
    return table(spark, d, "documents").where(F.contains("text", F.lit("|"))).select("doc_id", MD.body_rows(F.col("text")).cast("long").alias("body"))


TABLES = [
    (1, "| a | b |\n|---|---|\n| 1 | 2 |"), (2, "| a | b |\n| 1 | 2 |"), (3, "| a | b |"), (4, "| a | b |\n|---|---|\n| 1 |"), (5, "| a \\| x | b |\n|---|---|\n| 1 | 2 |"), (6, None),
]


@query("table_guard", "SELECT * FROM (VALUES (1, NULL), (2, 'no separator'), (3, 'too few lines'), (4, 'uneven columns'), (5, NULL), (6, 'too few lines')) t(id, error)")
def table_guard(spark, d):
    return S.inline(spark, "id int, md string", TABLES).select("id", MD.table_error(F.col("md")).alias("error"))


FULL, PART, DRIFT = "| H |\n|---|\n| a |\n| b |\n| c |", "| H |\n|---|\n| a |\n| b |", "|  h |\n|---|\n|  A |\n| b |\n| c |"
DEDUPE = [(1, [PART, FULL]), (2, [FULL, PART]), (3, [FULL, DRIFT]), (4, [PART]), (5, [])]


@query("table_dedupe", f"WITH {S.values('t', 'id, n, first', [(1, 1, FULL), (2, 1, FULL), (3, 1, FULL), (4, 1, PART), (5, 0, None)])} SELECT id, n, first FROM t")
def table_dedupe(spark, d):
    out = MD.dedupe(F.col("t"))
    return S.inline(spark, "id int, t array<string>", DEDUPE).select("id", F.size(out).alias("n"), F.get(out, F.lit(0)).alias("first"))


INLINE = [(1, "Explanation:\n| a | b |\n|---|---|\n| 1 | 2 |\nEnd.", "Explanation:\nEnd.", 1), (2, "x\n| a |\n| b |\ny", "x\n| a |\n| b |\ny", 0), (3, "| a |\n| b |\n| c |", "", 1), (4, "", "", 0)]


@query("inline_tables", f"WITH {S.values('t', 'id, text, prose, tables', INLINE)} SELECT id, prose, tables FROM t")
def inline_tables(spark, d):
    out = MD.split_inline(F.col("text"))
    return S.inline(spark, "id int, text string, prose string, tables int", INLINE).select("id", out["prose"].alias("prose"), F.size(out["tables"]).alias("tables"))


@query(
    "inline_tables_documents",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents),
p AS (SELECT *, {PIPED} AS on_ FROM l), g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, on_ ORDER BY i) AS run FROM p)
SELECT doc_id, count(*) AS tables FROM (SELECT doc_id, run FROM g WHERE on_ GROUP BY doc_id, run HAVING count(*) >= 3) GROUP BY 1""",
)
def inline_tables_documents(spark, d):
    out = table(spark, d, "documents").select("doc_id", F.size(MD.split_inline(F.col("text"))["tables"]).cast("long").alias("tables"))
    return out.where("tables > 0")


PAGES = [
    (1, 1, "1. First stem\n2. Second stem\nnothing"), (1, 2, "Solution to Question 7: because\n13. B\n14. C\n15. A"), (1, 3, "| 13 | C |\n| 16 | d |\n2 - A"), (2, 1, "Q. 4) stem\nQuestion 5: stem"), (2, 2, None),
]
KNOWN = [(1, 1), (1, 2), (1, 7), (1, 13), (1, 16), (2, 4), (2, 5)]


def _hit(pattern: str, kind: str, letter: bool) -> str:
    k = f"upper(regexp_extract(m, {S.q(pattern)}, 2))" if letter else "''"
    return f"SELECT chapter, page, '{kind}' AS kind, CAST(regexp_extract(m, {S.q(pattern)}, 1) AS INT) AS q_no, {k} AS letter FROM (SELECT chapter, page, unnest(regexp_extract_all(coalesce(text, ''), {S.q(pattern)})) AS m FROM pg)"


_HITS = f"{S.values('pg', 'chapter, page, text', PAGES)}, h AS (" + " UNION ALL ".join(
    [_hit(P.PRINTED_STEM, "question", False), _hit(P.SOLUTION_TO_QUESTION, "solution", False), *[_hit(p, "answer", True) for p in (P.KEY_ROW_PIPE, P.KEY_ROW_DOT, P.KEY_ROW_DASH)]]
) + ")"


@query(
    "anchor_harvest",
    f"""WITH {_HITS}, {S.values("kn", "chapter, q_no", KNOWN)}
SELECT chapter, q_no, kind, min(page) AS page, arg_min(letter, (page, letter)) AS letter FROM h WHERE EXISTS (SELECT 1 FROM kn WHERE kn.chapter = h.chapter AND kn.q_no = h.q_no) GROUP BY ALL""",
)
def anchor_harvest(spark, d):
    return A.harvest(S.inline(spark, "chapter int, page int, text string", PAGES), S.inline(spark, "chapter int, q_no int", KNOWN))


_PG = lambda k: f"coalesce(string_agg(DISTINCT CAST(page AS VARCHAR), ',' ORDER BY CAST(page AS VARCHAR)) FILTER (kind = '{k}'), '') AS {k}"


@query("page_locator", f"WITH {_HITS} SELECT chapter, q_no, {_PG('question')}, {_PG('answer')}, {_PG('solution')} FROM h GROUP BY ALL")
def page_locator(spark, d):
    return A.locate(S.inline(spark, "chapter int, page int, text string", PAGES))


@query(
    "anchor_documents",
    f"""WITH pg AS (SELECT source AS chapter, doc_id AS page, text FROM documents), h AS ({_hit(P.PRINTED_STEM, "question", False)} UNION ALL {_hit(P.KEY_ROW_PIPE, "answer", True)})
SELECT chapter, q_no, kind, min(page) AS page FROM h GROUP BY ALL""",
)
def anchor_documents(spark, d):
    pages = table(spark, d, "documents").select(F.col("source").alias("chapter"), F.col("doc_id").alias("page"), "text")
    return A.harvest(pages).where("kind <> 'solution'").drop("letter")


KEY_PAGES = [(1, 1, "1  A\n2  B"), (1, 2, "Answer Key\n1  A\n2  b"), (1, 3, "| 3 | C |\n1  D\nDetailed Explanations"), (1, 4, "4  A"), (1, 5, "Correct Option\n| 5 | D |")]


@query("answer_key_rows", "SELECT * FROM (VALUES (1, 1, 'A'), (1, 2, 'B'), (1, 3, 'C'), (1, 5, 'D')) t(chapter, q_no, letter)")
def answer_key_rows(spark, d):
    return A.printed_key(S.inline(spark, "chapter int, page int, text string", KEY_PAGES))


KEYED = [("answer", "Question | Correct Option\n1 | A"), ("table", "| a |"), ("table", "|  A |"), ("table", "| b |"), ("answer key", "other")]


@query("heal_tables", "SELECT * FROM (VALUES (1, '| a |;| b |;other', 3)) t(id, kept, n)")
def heal_tables(spark, d):
    df = S.inline(spark, "id int, t array<struct<type:string,markdown:string>>", [(1, KEYED)])
    once = H.drop_tables(F.col("t"))
    return df.withColumn("h", once).withColumn("h", H.drop_tables(F.col("h"))).select("id", F.array_join(F.transform("h", lambda x: x["markdown"]), ";").alias("kept"), F.size("h").alias("n"))


DUMPS = [(1, 1, "Own text.\nSolution to Question 2: dumped"), (1, 2, "Own of two"), (1, 3, "Text Solution to Question 9: no donor"), (1, 4, "Solution to Question 4: own header"), (1, 5, None)]


@query("heal_dump_tail", f"WITH {S.values('t', 'chapter, q_no, healed', [(1, 1, 'Own text.'), *[(c, n, s) for c, n, s in DUMPS[1:]]])} SELECT * FROM t")
def heal_dump_tail(spark, d):
    return H.trim_dumps(S.inline(spark, "chapter int, q_no int, solution string", DUMPS)).drop("solution")


SIBLINGS = [(1, 1, 0, PART), (1, 2, 0, FULL), (1, 3, 0, "| H |\n|---|\n| z |"), (2, 4, 0, PART)]


@query("heal_tables_from_siblings", f"WITH {S.values('t', 'id, healed', [(1, FULL), (2, FULL), (3, SIBLINGS[2][3]), (4, PART)])} SELECT * FROM t")
def heal_tables_from_siblings(spark, d):
    return H.complete_tables(S.inline(spark, "chapter int, id int, pos int, markdown string", SIBLINGS)).select("id", "healed")


@query("heal_archive", f"WITH {S.values('t', 'id, before, after', [(1, PART, FULL)])} SELECT * FROM t")
def heal_archive(spark, d):
    df = S.inline(spark, "chapter int, id int, pos int, markdown string", SIBLINGS)
    return H.archive(df, H.complete_tables(df).select("id", F.col("healed").alias("markdown")), ["id"], "markdown")


LONG = "| H |\n|---|\n" + "\n".join(f"| {k} |" for k in "abcdef")


@query("truncated_tables", "SELECT * FROM (VALUES (1, 1, 2, 6)) t(chapter, id, rows, largest)")
def truncated_tables(spark, d):
    return H.short_siblings(S.inline(spark, "chapter int, id int, markdown string", [(1, 1, PART), (1, 2, LONG), (1, 3, "| Other |\n|---|\n| a |"), (2, 4, PART)]))


FRAGMENTS = [(1, "First para.\n\nSecond para.", "has first  PARA. here"), (2, "Same", "the same text"), (3, None, "x"), (4, "New", None)]


@query("paragraph_novelty", "SELECT * FROM (VALUES (1, 'Second para.'), (2, ''), (3, ''), (4, 'New')) t(id, missing)")
def paragraph_novelty(spark, d):
    return S.inline(spark, "id int, f string, c string", FRAGMENTS).select("id", F.array_join(H.missing_paragraphs(F.col("f"), F.col("c")), "|").alias("missing"))


ORPHANS = [(1, 1, "solution", "new text", 2, None, None, None), (2, 1, "solution", "already here", 1, 3, None, None), (3, 1, "options", "opts", None, None, None, 2), (4, 1, "solution", "prose", None, None, None, 3), (5, 1, "stem", "s", 9, None, 1, None)]
OWNED = [(1, 1, "solution", "the text is ALREADY here"), (1, 2, "solution", ""), (1, 3, "solution", None), (1, 2, "options", None), (1, 1, "stem", "full")]


@query("orphan_ladder", "SELECT * FROM (VALUES (1, 2, 'self_labelled', 'filled'), (2, 1, 'self_labelled', 'consumed'), (3, NULL, NULL, 'blocked'), (4, 3, 'page_position', 'filled'), (5, NULL, NULL, 'blocked')) t(orphan, owner, rule, outcome)")
def orphan_ladder(spark, d):
    o = S.inline(spark, "orphan int, chapter int, field string, value string, label int, carry_no int, last_no int, page_no int", ORPHANS)
    return H.recover_orphans(o, S.inline(spark, "chapter int, q_no int, field string, value string", OWNED))


PHANTOM = [(1, 25, None, "the lens is thick and clear", False), (1, 26, None, "something else entirely", False), (1, 27, None, "the lens is thick and clear", True), (1, 28, "stem", "the lens is thick and clear", False)]


@query("phantom_drop", "SELECT 1 AS chapter, 25 AS q_no, CAST(1.0 AS DOUBLE) AS score")
def phantom_drop(spark, d):
    prior = S.inline(spark, "q_no int, solution string", [(25, "as said the lens is thick and clear"), (26, "the cornea"), (27, "the lens is thick and clear"), (28, "the lens is thick and clear")])
    return H.drop_phantoms(S.inline(spark, "chapter int, q_no int, stem string, solution string, question_pass boolean", PHANTOM), prior)


GLUED = [(1, 18, "full"), (1, 19, None), (1, 20, "Text of 19.\nSolution to Question 20: own text"), (2, 1, "x"), (2, 2, "y Solution to Question 2: z")]


@query("head_donation", "SELECT * FROM (VALUES (1, 18, 'full'), (1, 19, 'Text of 19.'), (1, 20, 'Solution to Question 20: own text'), (2, 1, 'x'), (2, 2, 'y Solution to Question 2: z')) t(chapter, q_no, healed)")
def head_donation(spark, d):
    return H.donate_heads(S.inline(spark, "chapter int, q_no int, solution string", GLUED)).drop("solution")


@query("record_keys", "SELECT doc_id, printf('%s-%03d-%03d', upper(lang), doc_id % 7, doc_id // 7) AS id, printf('%s-%03d', upper(lang), doc_id % 7) AS chapter, CAST(doc_id // 7 AS INT) AS q_no FROM documents")
def record_keys(spark, d):
    r = table(spark, d, "documents").select("doc_id", K.record_id(F.upper("lang"), F.col("doc_id") % 7, F.floor(F.col("doc_id") / 7)).alias("id"))
    return r.select("doc_id", "id", K.chapter_of(F.col("id")).alias("chapter"), K.q_no(F.col("id")).alias("q_no"))


DETAILS = [(1, "figure on pages [3, 14] lost"), (2, "pdf_pages [7]"), (3, "nothing"), (4, None), (5, "pages []")]


@query("pages_in_details", "SELECT * FROM (VALUES (1, '3,14'), (2, '7'), (3, ''), (4, ''), (5, '')) t(id, pages)")
def pages_in_details(spark, d):
    return S.inline(spark, "id int, d string", DETAILS).select("id", F.array_join(K.pages_in(F.col("d")).cast("array<string>"), ",").alias("pages"))


SLOTS = [("S/a_Q_01.webp",), ("S/a_Q_07.webp",), ("S/a_SOL_09.webp",), ("S/b_Q_99.webp",)]


@query("next_slot", "SELECT 8 AS next, 1 AS fresh")
def next_slot(spark, d):
    df = S.inline(spark, "name string", SLOTS)
    return df.agg(O.next_slot(df, F.lit("S/a_Q_")).alias("next"), O.next_slot(df, F.lit("S/zz_")).alias("fresh"))


@query("lookup_questions", "SELECT doc_id FROM documents WHERE strpos(lower(source || '-' || doc_id), 'src1-') > 0")
def lookup_questions(spark, d):
    return table(spark, d, "documents").where(F.contains(F.lower(F.concat_ws("-", "source", F.col("doc_id").cast("string"))), F.lit("src1-"))).select("doc_id")


@query("letter_flip", "SELECT * FROM (VALUES (1, 'B', true), (2, 'A', false), (3, NULL, false)) t(id, best, flip)")
def letter_flip(spark, d):
    """Which option a solution's opening describes, against the keyed letter."""
    rows = [(1, "A", "The optic nerve carries the impulse.", {"A": "corneal nerve ending", "B": "optic nerve"}), (2, "A", "The corneal nerve ending hurts.", {"A": "corneal nerve ending", "B": "optic nerve"}), (3, "A", "", {"A": "x", "B": "y"})]
    df = S.inline(spark, "id int, key string, solution string, options map<string,string>", rows)
    each = df.select("id", "key", "solution", F.explode("options").alias("k", "t"))
    s = each.withColumn("s", X.overlap(X.tokens(F.col("t")), X.tokens(F.substring("solution", 1, 200))))
    best = s.groupBy("id", "key").agg(F.max(F.struct("s", "k")).alias("b"))
    top = F.when(F.col("b.s") > 0, F.col("b.k"))
    return best.select("id", top.alias("best"), F.coalesce(top != F.col("key"), F.lit(False)).alias("flip"))


@query(
    "digest_tiers",
    """WITH k AS (SELECT source AS subject, CASE WHEN n_chars < 200 THEN 'BLOCKER' WHEN lang <> 'en' THEN 'REVIEW' ELSE 'NOISE' END AS tier FROM documents)
SELECT subject, tier, count(*) AS n FROM k GROUP BY ALL""",
)
def digest_tiers(spark, d):
    tier = F.when(F.col("n_chars") < 200, "BLOCKER").when(F.col("lang") != "en", "REVIEW").otherwise("NOISE")
    return table(spark, d, "documents").groupBy(F.col("source").alias("subject"), tier.alias("tier")).agg(F.count("*").alias("n"))


@query("call_metrics", "SELECT o_orderstatus AS chapter, count(*) AS spent, count(*) FILTER (o_totalprice > 200000) AS applied, round(count(*) FILTER (o_totalprice > 200000) / nullif(count(*), 0), 3) AS fix_per_call FROM orders GROUP BY 1")
def call_metrics(spark, d):
    g = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("chapter")).agg(F.count("*").alias("spent"), F.count_if(F.col("o_totalprice") > 200000).alias("applied"))
    return g.withColumn("fix_per_call", F.round(F.col("applied") / F.nullif(F.col("spent"), F.lit(0)), 3))
