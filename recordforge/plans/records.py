"""Queries over numbered records: adapters bind the driver's tables to chapters, numbers, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.functions import text as X
from recordforge.operators import records as R
from recordforge.operators import rules

from . import sql as S
from .evidence import _CONTAMINATION, REST, STEM, docs, split_text
from .registry import query


def table(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def numbered(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").cast("long").alias("q_no"))


@query(
    "numbering_gaps",
    """WITH n AS (SELECT DISTINCT l_orderkey AS chapter, CAST(l_linenumber AS BIGINT) AS q_no FROM lineitem),
x AS (SELECT *, lead(q_no) OVER (PARTITION BY chapter ORDER BY q_no) AS nxt FROM n)
SELECT chapter, q_no + 1 AS from_no, nxt - 1 AS to_no FROM x WHERE nxt > q_no + 1""",
)
def numbering_gaps(spark, d):
    return R.numbering_gaps(numbered(spark, d))


@query("numbering_start", "SELECT l_orderkey AS chapter, CAST(min(l_linenumber) AS BIGINT) AS first_no FROM lineitem GROUP BY 1 HAVING min(l_linenumber) <> 1")
def numbering_start(spark, d):
    return R.numbering_start(numbered(spark, d))


@query("duplicate_ids", "SELECT l_orderkey AS chapter, CAST(l_linenumber AS BIGINT) AS q_no, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return R.duplicates(numbered(spark, d), "chapter", "q_no")


@query(
    "connected_runs",
    """WITH n AS (SELECT DISTINCT l_orderkey AS chapter, CAST(l_linenumber AS BIGINT) AS q_no FROM lineitem),
i AS (SELECT *, q_no - row_number() OVER (PARTITION BY chapter ORDER BY q_no) AS island FROM n),
r AS (SELECT chapter, min(q_no) AS first_no, max(q_no) AS last_no, count(*) AS size FROM i GROUP BY chapter, island)
SELECT *, size >= 5 OR last_no = max(last_no) OVER (PARTITION BY chapter) AS trusted FROM r""",
)
def connected_runs(spark, d):
    return R.connected_runs(numbered(spark, d))


def _rates(spark, d):
    """Orders without line items, by month of the order."""
    have = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("has", F.lit(1))
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("chapter")).join(have, "o_orderkey", "left")
    return o.groupBy("chapter").agg(F.count("*").alias("n"), F.avg(F.when(F.col("has").isNull(), 1.0).otherwise(0.0)).alias("rate"))


_RATES = """r AS (SELECT strftime(o_orderdate, '%Y-%m') AS chapter, count(*) AS n, avg(CASE WHEN l.k IS NULL THEN 1.0 ELSE 0.0 END) AS rate
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON l.k = o_orderkey GROUP BY 1)"""


@query("missing_rate", f"WITH {_RATES} SELECT * FROM r")
def missing_rate(spark, d):
    return _rates(spark, d)


@query(
    "density_alarm",
    f"""WITH {_RATES}, m AS (SELECT list_sort(list(rate))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS median FROM r)
SELECT chapter, rate, median, rate >= greatest(0.5, median * 3.0) AS alarm FROM r, m""",
)
def density_alarm(spark, d):
    return R.density(_rates(spark, d).select("chapter", "rate"))


def _answers(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    r = split_text(docs(spark, d)).select("doc_id", F.col("source").alias("chapter"), F.col("doc_id").alias("q_no"), "stem", "solution", "lang")
    return r.join(labels, "doc_id", "left").withColumn("answer", F.when(F.col("quality").isNotNull(), F.substring(F.lit("ABCD"), F.col("quality") * 2 + F.col("toxic") + 1, F.lit(1))))


_ANS = f"""rec AS (SELECT d.doc_id, source AS chapter, d.doc_id AS q_no, {STEM} AS stem, {REST} AS solution, lang,
  CASE WHEN quality IS NOT NULL THEN substr('ABCD', quality * 2 + toxic + 1, 1) END AS answer
  FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id)"""
_BL = lambda x: f"{S.strip(f'coalesce({x}, {chr(39)}{chr(39)})')} = ''"


@query(
    "answer_key_only",
    f"""WITH {_ANS}, g AS (SELECT chapter, count(*) AS n, count(*) FILTER (answer IS NOT NULL) AS answered, count(*) FILTER (answer IS NOT NULL AND {_BL("solution")}) AS bare,
  count(*) FILTER ({_BL("solution")}) AS missing FROM rec GROUP BY 1)
SELECT *, n >= 5 AND answered > 0 AND bare >= answered * 0.8 AS key_only FROM g""",
)
def answer_key_only(spark, d):
    return R.answer_key_only(_answers(spark, d))


@query(
    "key_vs_extracted",
    """WITH e AS (SELECT doc_id % 7 AS chapter, doc_id // 7 AS q_no, CASE WHEN quality = 1 THEN 'A' ELSE 'B' END AS answer FROM labels),
p AS (SELECT doc_id % 7 AS chapter, doc_id // 7 AS q_no, CASE WHEN toxic = 0 THEN 'A' ELSE 'B' END AS key FROM labels UNION ALL SELECT 1, 1000000, 'C'),
n AS (SELECT chapter, count(*) AS n FROM e GROUP BY 1),
j AS (SELECT p.*, p.q_no > coalesce(n.n, 0) AS stray, e.answer FROM p LEFT JOIN n USING (chapter) LEFT JOIN e ON e.chapter = p.chapter AND e.q_no = p.q_no)
SELECT chapter, count(*) AS keyrows, count(*) FILTER (stray) AS strays, count(*) FILTER (NOT stray AND answer IS NULL) AS missing,
  count(*) FILTER (NOT stray AND answer = key) AS matched, count(*) FILTER (NOT stray AND answer <> key) AS flipped FROM j GROUP BY 1""",
)
def key_vs_extracted(spark, d):
    lab = table(spark, d, "labels").withColumn("chapter", F.col("doc_id") % 7).withColumn("q_no", F.floor(F.col("doc_id") / 7))
    e = lab.select("chapter", "q_no", F.when(F.col("quality") == 1, "A").otherwise("B").alias("answer"))
    p = lab.select("chapter", "q_no", F.when(F.col("toxic") == 0, "A").otherwise("B").alias("key"))
    return R.key_check(e, p.unionByName(spark.createDataFrame([(1, 1_000_000, "C")], "chapter long, q_no long, key string")))


@query(
    "qid_set_consistency",
    """WITH a AS (SELECT DISTINCT c_custkey AS id FROM customer), b AS (SELECT DISTINCT o_custkey AS id FROM orders), c AS (SELECT DISTINCT l_partkey AS id FROM lineitem),
x AS (SELECT coalesce(a.id, b.id, c.id) AS id, a.id IS NOT NULL AS in_a, b.id IS NOT NULL AS in_b, c.id IS NOT NULL AS in_c
  FROM a FULL JOIN b ON a.id = b.id FULL JOIN c ON coalesce(a.id, b.id) = c.id)
SELECT *, CAST(in_a AS INT) + CAST(in_b AS INT) + CAST(in_c AS INT) = 1 AS only_one FROM x WHERE NOT (in_a AND in_b AND in_c)""",
)
def qid_set_consistency(spark, d):
    col = lambda t, c: table(spark, d, t).select(F.col(c).alias("id"))
    return R.id_consistency(col("customer", "c_custkey"), col("orders", "o_custkey"), col("lineitem", "l_partkey"))


def _split(spark, d):
    r = _answers(spark, d).withColumn("q_id", F.concat_ws("-", "chapter", F.format_string("%06d", "q_no")))
    words = F.slice(F.split("solution", X.SPLIT), 1, 4)
    opts = F.map_from_arrays(F.slice(F.array(*map(F.lit, "ABCD")), F.lit(1), F.size(words)), words)
    return R.split_rows(r.withColumn("options", opts))


_SPLIT = f"""{_ANS}, sp AS (SELECT *, chapter || '-' || lpad(CAST(q_no AS VARCHAR), 6, '0') AS q_id, list_transform(range(1, 5), i -> coalesce(regexp_split_to_array(solution, '\\s+')[i], '')) AS o FROM rec)""".replace("i -> ", "lambda i: ")


@query(
    "split_questions",
    f"""WITH {_SPLIT}, m AS (SELECT *, array_to_string(list_filter([CASE WHEN {_BL("stem")} THEN 'question_text' END, CASE WHEN len(list_filter(o, lambda x: {_BL("x")})) > 0 THEN 'options' END],
  lambda x: x IS NOT NULL), ',') AS f FROM sp)
SELECT q_id, chapter, q_no, stem AS question_text, CASE WHEN f = '' THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS extraction_status, f AS missing_fields FROM m""",
)
def split_questions(spark, d):
    return _split(spark, d)[0].drop("options")


@query("split_answers", f"WITH {_SPLIT} SELECT q_id, chapter, q_no, answer AS correct_option, CASE WHEN answer IS NULL THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS extraction_status, CASE WHEN answer IS NULL THEN 'correct_option' ELSE '' END AS missing_fields FROM sp")
def split_answers(spark, d):
    return _split(spark, d)[1]


@query(
    "split_solutions",
    f"WITH {_SPLIT} SELECT q_id, chapter, q_no, md5(solution) AS solution_text, CASE WHEN {_BL('solution')} THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS extraction_status, CASE WHEN {_BL('solution')} THEN 'solution_text' ELSE '' END AS missing_fields FROM sp",
)
def split_solutions(spark, d):
    return _split(spark, d)[2].withColumn("solution_text", F.md5("solution_text"))


_COMPLETE = f"""{_SPLIT}, cm AS (SELECT chapter, count(*) AS question_records, count(*) AS answer_records, count(*) AS solution_records,
  count(*) FILTER ({_BL("stem")} OR len(list_filter(o, lambda x: {_BL("x")})) > 0) AS question_incomplete, count(*) FILTER (answer IS NULL) AS answer_incomplete,
  count(*) FILTER ({_BL("solution")}) AS solution_incomplete FROM sp GROUP BY 1)"""


@query("completeness", f"WITH {_COMPLETE} SELECT * FROM cm")
def completeness(spark, d):
    return R.completeness(*_split(spark, d))


def _graded(spark, d):
    r = _answers(spark, d)
    bit = lambda k: F.col("doc_id").bitwiseAND(F.lit(1 << k).cast("long")) != 0
    r = r.select("chapter", "q_no", *[bit(i).alias(a) for i, a in enumerate(R.ANCHORS)], (F.col("doc_id") % 3 == 0).alias("run"), (F.col("doc_id") % 5 == 0).alias("carry"),
                 F.when(F.col("lang") != "de", F.col("stem")).alias("stem"), F.when(F.col("lang") != "de", F.lit("x")).alias("options"), "answer", "solution")
    return R.grade(r)


_GRADE = f"""{_ANS}, g AS (SELECT chapter, q_no, (doc_id & 1) <> 0 AS ps, (doc_id & 2) <> 0 AS ph, (doc_id & 4) <> 0 AS kr, (doc_id & 8) <> 0 AS os, (doc_id & 16) <> 0 AS oh, doc_id % 3 = 0 OR doc_id % 5 = 0 AS held,
  CASE WHEN lang <> 'de' THEN stem END AS stem, CASE WHEN lang <> 'de' THEN 'x' END AS options, answer, solution FROM rec),
n AS (SELECT *, CAST(ps AS INT) + CAST(ph AS INT) + CAST(kr AS INT) + CAST(os AS INT) + CAST(oh AS INT) AS n FROM g),
k AS (SELECT *, CASE WHEN n = 0 AND held THEN 'RESOLVED' WHEN n = 0 THEN 'PROVISIONAL' WHEN n >= 2 AND (ps OR ph) THEN 'RESOLVED_ANCHORED' ELSE 'RESOLVED' END AS g0 FROM n),
z AS (SELECT *, CASE WHEN g0 = 'PROVISIONAL' AND {_BL("stem")} AND {_BL("options")} THEN CASE WHEN {_BL("solution")} THEN 'no_anchor_at_all' ELSE 'missing_question_for_solution' END
  WHEN g0 <> 'PROVISIONAL' AND ph AND NOT ps AND NOT kr AND ({_BL("options")} OR answer IS NULL) THEN 'missing_question_for_solution' END AS reason FROM k)"""


@query("grade_records", f"WITH {_GRADE} SELECT chapter, q_no, CASE WHEN reason IS NULL THEN g0 ELSE 'UNRESOLVED' END AS grade, reason FROM z")
def grade_records(spark, d):
    return _graded(spark, d).select("chapter", "q_no", "grade", "reason")


@query(
    "grade_counts",
    f"""WITH {_GRADE}, x AS (SELECT chapter, CASE WHEN reason IS NULL THEN g0 ELSE 'UNRESOLVED' END AS grade FROM z)
SELECT chapter, count(*) FILTER (grade = 'RESOLVED_ANCHORED') AS resolved_anchored, count(*) FILTER (grade = 'RESOLVED') AS resolved,
  count(*) FILTER (grade = 'PROVISIONAL') AS provisional, count(*) FILTER (grade = 'UNRESOLVED') AS unresolved FROM x GROUP BY 1""",
)
def grade_counts(spark, d):
    g = _graded(spark, d).select("chapter", "q_no", "grade").dropDuplicates(["chapter", "q_no"])
    n = lambda k: F.count_if(F.col("grade") == k).alias(k.lower())
    return g.groupBy("chapter").agg(*[n(k) for k in ("RESOLVED_ANCHORED", "RESOLVED", "PROVISIONAL", "UNRESOLVED")])


@query(
    "incomplete_records",
    f"""WITH {_SPLIT}, src AS (SELECT doc_id, text FROM documents), {_CONTAMINATION}, s AS (SELECT chapter, avg(CASE WHEN {_BL("solution")} THEN 0.0 ELSE 1.0 END) AS share FROM sp GROUP BY 1),
f AS (SELECT chapter, q_no, array_to_string(list_filter([CASE WHEN {_BL("stem")} OR sp.doc_id IN (SELECT doc_id FROM x WHERE reason IS NOT NULL) THEN 'stem' END,
  CASE WHEN len(list_filter(sp.o, lambda x: {_BL("x")})) > 0 THEN 'options' END, CASE WHEN answer IS NULL THEN 'answer' END,
  CASE WHEN {_BL("solution")} AND (share >= 0.6 OR q_no % 11 = 0) THEN 'solution' END], lambda x: x IS NOT NULL), ',') AS missing FROM sp JOIN s USING (chapter))
SELECT * FROM f WHERE missing <> ''""",
)
def incomplete_records(spark, d):
    words = F.slice(F.split("solution", X.SPLIT), 1, 4)
    opts = F.map_from_arrays(F.slice(F.array(*map(F.lit, "ABCD")), F.lit(1), F.size(words)), words)
    return R.incomplete(_answers(spark, d).withColumn("options", opts).withColumn("printed", F.col("q_no") % 11 == 0))


def ledger(spark, d):
    return table(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "value")


@query("keep_first", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events WHERE user_id IS NOT NULL) WHERE r = 1")
def keep_first(spark, d):
    return R.first_rows(ledger(spark, d), "user_id", "ts", "event_id").select("user_id", "event_id", "event_type")


@query("keep_last", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def keep_last(spark, d):
    return R.last_by(ledger(spark, d), "user_id", F.struct("ts", "event_id"), "event_id", "event_type")


_FILL = {t: f"CASE WHEN event_type = '{t}' THEN CAST(event_id AS VARCHAR) END" for t in ("signup", "purchase", "click", "view")}


@query(
    "merge_fill_only",
    "SELECT user_id, " + ", ".join(f"arg_min(CASE WHEN event_type = '{t}' THEN event_id END, (ts, event_id)) FILTER (event_type = '{t}') AS {t}" for t in _FILL) + " FROM events GROUP BY 1",
)
def merge_fill_only(spark, d):
    e = ledger(spark, d).select("user_id", "ts", "event_id", *[F.when(F.col("event_type") == t, F.col("event_id")).alias(t) for t in _FILL])
    return R.fill_only(e, "user_id", F.struct("ts", "event_id"), list(_FILL))


def _rule_records(spark, d):
    r = _answers(spark, d)
    words = F.slice(F.split("solution", X.SPLIT), F.lit(1), (F.col("doc_id") % 6).cast("int"))
    opts = F.transform(words, lambda w, i: F.struct(F.substring(F.lit("ABCDEF"), i + 1, F.lit(1)).alias("id"), w.alias("text")))
    none = F.array().cast("array<struct<type:string,markdown:string>>")
    return r.select(
        "chapter", "q_no", "stem", opts.alias("options"), F.when(F.col("answer").isNotNull(), F.array("answer")).otherwise(F.array().cast("array<string>")).alias("correct"), "solution",
        none.alias("tables"), (F.col("doc_id") % 13).cast("int").alias("question_images"), (F.col("doc_id") % 9).cast("int").alias("solution_images"),
        (F.col("doc_id") % 2 == 0).alias("declared_question"), (F.col("doc_id") % 3 == 0).alias("declared_solution"),
        F.when(F.col("doc_id") % 17 == 0, "INCOMPLETE").when(F.col("doc_id") % 19 == 0, "REVIEW_NEEDED").otherwise("READY").alias("qa_status"),
        F.when(F.col("doc_id") % 23 == 0, "prose").alias("stem_suspect"), F.when(F.col("doc_id") % 29 == 0, "other").alias("options_suspect"),
    )


_RULES = f"""{_ANS}, o AS (SELECT *, list_slice(regexp_split_to_array(solution, '\\s+'), 1, doc_id % 6) AS w, rtrim(solution, ' ') AS st FROM rec),
t AS (SELECT *, {S.strip("solution")} AS ss, regexp_replace(solution, {S.q(S.X._RUN + "$")}, '') AS rs FROM o), k AS ("""


def _flag(kind: str, severity: str, where: str) -> str:
    return f"SELECT chapter, q_no, '{kind}' AS kind, '{severity}' AS severity FROM t WHERE {where}"


_IMG = "doc_id % 9 > 0"
_RULES += " UNION ALL ".join(
    [
        _flag("qa_incomplete", "high", "doc_id % 17 = 0"),
        _flag("qa_review_needed", "low", "doc_id % 19 = 0 AND doc_id % 17 <> 0"),
        _flag("suspect_stem", "high", "doc_id % 23 = 0"),
        _flag("options_suspect", "high", "doc_id % 29 = 0"),
        _flag("empty_question", "high", _BL("stem")),
        _flag("bad_options", "high", "len(w) <> 4 OR len(list_filter(w, lambda x: trim(x) <> '')) <> 4"),
        _flag("blank_correct_option", "high", "answer IS NOT NULL AND trim(coalesce(w[strpos('ABCD', answer)], '')) = ''"),
        _flag("missing_answer", "high", "answer IS NULL"),
        _flag("answer_mismatch", "high", "answer IS NOT NULL AND strpos('ABCD', answer) > len(w)"),
        _flag("missing_solution", "high", "ss = ''"),
        _flag("truncated_solution", "high", f"ss <> '' AND ((regexp_matches(rs, {S.q(S.P.DANGLING_END)}) AND NOT (ends_with(rs, ':') AND {_IMG})) OR (solution <> rs AND regexp_matches(rs, '[A-Za-z0-9]$')))"),
        _flag("short_bare_solution", "low", f"ss <> '' AND NOT ((regexp_matches(rs, {S.q(S.P.DANGLING_END)}) AND NOT (ends_with(rs, ':') AND {_IMG})) OR (solution <> rs AND regexp_matches(rs, '[A-Za-z0-9]$'))) AND length(rs) < 60 AND strpos({S.q(S.P.TERMINAL)}, right(rs, 1)) = 0 AND NOT {_IMG}"),
        _flag("declared_figure_missing", "low", "(doc_id % 2 = 0 AND doc_id % 13 = 0) OR (doc_id % 3 = 0 AND doc_id % 9 = 0)"),
        _flag("over_attributed_images", "low", "doc_id % 13 > 8"),
        _flag("over_attributed_solution_images", "low", "doc_id % 9 > 6"),
    ]
) + ")"
_KINDS = ["qa_incomplete", "qa_review_needed", "suspect_stem", "options_suspect", "empty_question", "bad_options", "blank_correct_option", "missing_answer", "answer_mismatch", "missing_solution",
          "truncated_solution", "short_bare_solution", "declared_figure_missing", "over_attributed_images", "over_attributed_solution_images"]


@query("row_flags", f"WITH {_RULES} SELECT * FROM k")
def row_flags(spark, d):
    return rules.row_flags(_rule_records(spark, d), _KINDS)


@query("flag_summary", f"WITH {_RULES} SELECT kind, severity, count(*) AS flags, count(DISTINCT chapter) AS chapters FROM k GROUP BY ALL")
def flag_summary(spark, d):
    return rules.flag_summary(rules.row_flags(_rule_records(spark, d), _KINDS))


@query("flag_summary_all_rules")
def flag_summary_all_rules(spark, d):
    return rules.flag_summary(rules.row_flags(_rule_records(spark, d)))


@query(
    "hot_page_upgrade",
    """WITH f AS (SELECT o_custkey AS chapter, o_orderkey AS q_no, p.pos, 'declared_figure_missing' AS kind, 'low' AS severity FROM orders, (SELECT unnest([1, 2]) AS pos) p WHERE o_orderstatus = 'O'),
g AS (SELECT o_custkey AS chapter, o_orderkey AS q_no, min(l_linenumber) AS a, max(l_linenumber) AS b FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL),
h AS (SELECT DISTINCT o_custkey AS chapter, CAST(floor(o_totalprice) AS BIGINT) % 12 AS page FROM orders WHERE o_orderpriority = '1-URGENT')
SELECT f.chapter, f.q_no, f.pos, f.kind, CASE WHEN pos = 2 AND EXISTS (SELECT 1 FROM g JOIN h ON h.chapter = g.chapter WHERE g.chapter = f.chapter AND g.q_no = f.q_no AND page BETWEEN a - 1 AND b + 2)
  THEN 'high' ELSE severity END AS severity FROM f""",
)
def hot_page_upgrade(spark, d):
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    flags = o.where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("q_no"), F.explode(F.array(F.lit(1), F.lit(2))).alias("pos"))
    flags = flags.withColumn("kind", F.lit("declared_figure_missing")).withColumn("severity", F.lit("low"))
    pages = o.join(li, o.o_orderkey == li.l_orderkey).groupBy(F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("q_no"))
    pages = pages.agg(F.min("l_linenumber").alias("first_page"), F.max("l_linenumber").alias("last_page"))
    hot = o.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("chapter"), (F.floor("o_totalprice") % 12).alias("page")).distinct()
    return rules.upgrade_severity(flags, pages, hot)
