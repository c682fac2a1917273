"""Queries of text evidence over documents and benchmark."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions import text as X
from recordforge.operators import pairs

from . import sql as S
from .registry import query


def docs(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet")


def split_text(df):
    """Stem: the first line of a text; solution: the rest."""
    at = F.instr("text", "\n")
    stem = F.when(at > 0, F.substring("text", F.lit(1), at - 1)).otherwise(F.col("text"))
    return df.withColumn("stem", stem).withColumn("solution", F.when(at > 0, F.substring("text", at + 1, F.char_length("text"))).otherwise(""))


STEM = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END"
REST = "CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END"


def _shingle_cte(table: str, key: str, n: int) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(w[i : i + {n - 1}], ' ') AS s FROM (SELECT {key}, w, unnest(range(1, len(w) - {n - 2})) AS i FROM {table})"


@query(
    "evidence_overlap",
    f"""
WITH d AS (SELECT doc_id AS id, {S.tokens("text")} AS w FROM documents), b AS (SELECT item_id AS page, {S.tokens("text")} AS w FROM benchmark),
ds AS ({_shingle_cte("d", "id", 8)}), bs AS ({_shingle_cte("b", "page", 8)}),
p AS (SELECT DISTINCT id, page FROM ds JOIN bs USING (s)),
x AS (SELECT id, page, {S.overlap("d.w", "b.w")} AS score FROM p JOIN d USING (id) JOIN b USING (page))
SELECT id, page, score, CASE WHEN score >= 0.95 THEN 'auto' WHEN score >= 0.8 THEN 'human' ELSE 'reject' END AS verdict FROM x""",
)
def evidence_overlap(spark, d):
    pages = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("page"), "text")
    return pairs.evidence(docs(spark, d).select(F.col("doc_id").alias("id"), "text"), pages)


@query(
    "adjudicate_verdict",
    f"""
WITH d AS (SELECT doc_id AS id, {S.tokens("text")} AS w FROM documents), b AS (SELECT item_id AS page, {S.tokens("text")} AS w FROM benchmark),
ds AS ({_shingle_cte("d", "id", 8)}), bs AS ({_shingle_cte("b", "page", 8)}),
p AS (SELECT DISTINCT id, page FROM ds JOIN bs USING (s)),
x AS (SELECT id, page, {S.overlap("b.w", "d.w")} AS score FROM p JOIN d USING (id) JOIN b USING (page))
SELECT page, count(*) AS documents, max(score) AS best, count(*) FILTER (score >= 0.95) AS auto, count(*) FILTER (score >= 0.8 AND score < 0.95) AS human FROM x GROUP BY page""",
)
def adjudicate_verdict(spark, d):
    """How well each benchmark item is covered by documents: its candidates are the items themselves."""
    items = spark.read.parquet(f"{d}/benchmark.parquet").select(F.col("item_id").alias("id"), "text")
    found = pairs.evidence(items, docs(spark, d).select(F.col("doc_id").alias("page"), "text"))
    n = lambda v: F.count_if(F.col("verdict") == v).alias(v)
    return found.groupBy(F.col("id").alias("page")).agg(F.count("*").alias("documents"), F.max("score").alias("best"), n("auto"), n("human"))


@query(
    "coherence_score",
    f"""
WITH r AS (SELECT doc_id, list_filter({S.tokens(STEM)}, lambda t: length(t) > 2) AS a, list_distinct({S.tokens(REST)}) AS b FROM documents)
SELECT doc_id, CASE WHEN len(a) = 0 THEN 0.0 ELSE len(list_filter(a, lambda t: list_contains(b, t))) / CAST(len(a) AS DOUBLE) END AS coherence FROM r""",
)
def coherence_score(spark, d):
    return split_text(docs(spark, d)).select("doc_id", X.coherence(F.col("stem"), F.col("solution")).alias("coherence"))


_CONTAMINATION = f"""
r AS (SELECT doc_id, {S.strip(f"coalesce({STEM}, '')")} AS t, {S.strip(f"coalesce({REST}, '')")} AS s FROM src),
w AS (SELECT *, {S.tokens("t")} AS a, {S.tokens("s")} AS b FROM r),
o AS (SELECT *, CASE WHEN s <> '' AND length(t) >= 60 THEN {S.overlap("a", "b")} ELSE 0 END AS ab, CASE WHEN s <> '' AND length(t) >= 60 THEN {S.overlap("b", "a")} ELSE 0 END AS ba FROM w),
x AS (SELECT doc_id, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, {S.q(P.EXPLANATION_START)}) THEN 'opener'
  WHEN s = '' OR length(t) < 60 OR ab < 0.8 THEN NULL WHEN ba >= 0.8 THEN 'verbatim'
  WHEN length(t) > 250 OR NOT regexp_matches(t, {S.q(P.QUESTION_SHAPED)}) THEN 'contained' END AS reason FROM o)"""


@query("stem_contamination", f"WITH src AS (SELECT doc_id, text FROM documents), {_CONTAMINATION} SELECT doc_id, reason FROM x WHERE reason IS NOT NULL")
def stem_contamination(spark, d):
    out = split_text(docs(spark, d)).select("doc_id", X.contamination(F.col("stem"), F.col("solution")).alias("reason"))
    return out.where("reason is not null")


CONTAMINATION_ROWS = [
    (1, "Option A: this is wrong because of the lens\nOption A: this is wrong because of the lens"),
    (2, "The correct answer is B here\nrest"),
    (3, "Which of the following drugs is used for the treatment of acute angle closure glaucoma in adults?\nAcute angle closure glaucoma in adults: which of the following drugs is used for the treatment of it? Many are. Start with the pressure and go on with care."),
    (4, "Pilocarpine constricts the pupil and opens the drainage angle of the anterior chamber\nPilocarpine constricts the pupil and opens the drainage angle of the anterior chamber"),
    (5, "Pilocarpine constricts the pupil and opens the drainage angle of the anterior chamber\nAs known, pilocarpine constricts the pupil and opens the drainage angle of the anterior chamber; other agents lower the production of fluid and are given first in most centres."),
    (6, "   \nx"),
    (7, "short stem\nshort stem"),
]


@query("stem_contamination_cases", f"WITH {S.values('src', 'doc_id, text', CONTAMINATION_ROWS)}, {_CONTAMINATION} SELECT doc_id, reason FROM x")
def stem_contamination_cases(spark, d):
    df = S.inline(spark, "doc_id int, text string", CONTAMINATION_ROWS)
    return split_text(df).select("doc_id", X.contamination(F.col("stem"), F.col("solution")).alias("reason"))


_NOISE = " OR ".join(f"regexp_matches(l, {S.q(p)})" for p in P.NOISE_LINES)
NOISE_ROWS = [(1, "prose\n12\n- 45 -\nPage 12 of 300\nmore 12"), (2, "https://example.com/x\n© 2020 Someone\n(c) x\nHeader"), (3, None), (4, "1\n2\n3\n4\n5\n6\r\n7")]
_NOISE_SQL = f"""
l AS (SELECT id, unnest(regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\n|\\r')) AS l, unnest(range(1, 100000)) AS i FROM src),
k AS (SELECT id, l, i, row_number() OVER (PARTITION BY id, {_NOISE} ORDER BY i) AS r, {_NOISE} AS noise FROM l WHERE l IS NOT NULL)
SELECT id, coalesce(string_agg(substr({S.strip("l")}, 1, 60), ' | ' ORDER BY i) FILTER (noise AND r <= 5), '') AS noise,
       coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT noise), '') AS clean FROM k GROUP BY id"""


def _noise(df):
    return df.select("id", F.array_join(X.noise_lines(F.col("text")), " | ").alias("noise"), X.without_noise(F.col("text")).alias("clean"))


@query("noise_lines", f"WITH {S.values('src', 'id, text', NOISE_ROWS)}, {_NOISE_SQL}")
def noise_lines(spark, d):
    return _noise(S.inline(spark, "id int, text string", NOISE_ROWS))


@query(
    "noise_documents",
    f"""WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\\r\\n|\\n|\\r')) AS l FROM documents)
SELECT doc_id, count(*) AS noise FROM l WHERE {_NOISE} GROUP BY doc_id""",
)
def noise_documents(spark, d):
    n = F.size(F.filter(X.lines(F.col("text")), X.is_noise)).cast("long")
    return docs(spark, d).select("doc_id", n.alias("noise")).where("noise > 0")


@query(
    "shingle_pairs",
    f"""
WITH d AS (SELECT doc_id AS id, source AS chapter, {S.tokens("text")} AS w FROM documents),
s AS (SELECT DISTINCT chapter, id, array_to_string(w[i : i + 7], ' ') AS s FROM (SELECT chapter, id, w, unnest(range(1, len(w) - 6)) AS i FROM d))
SELECT a.chapter, a.id AS a, b.id AS b, count(*) AS common FROM s a JOIN s b ON a.chapter = b.chapter AND a.s = b.s AND a.id < b.id
GROUP BY ALL HAVING count(*) >= 25""",
)
def shingle_pairs(spark, d):
    return pairs.shared_shingles(docs(spark, d).select(F.col("source").alias("chapter"), F.col("doc_id").alias("id"), "text"))


@query("near_duplicate_docs")
def near_duplicate_docs(spark, d):
    return pairs.near_duplicates(docs(spark, d).select(F.col("source").alias("chapter"), F.col("doc_id").alias("id"), "text"))


@query("shared_segment")
def shared_segment(spark, d):
    return pairs.shared_segments(docs(spark, d).select(F.col("source").alias("chapter"), F.col("doc_id").alias("id"), "text"))


@query(
    "exact_duplicate_docs",
    f"""WITH n AS (SELECT source, doc_id, {S.norm("text")} AS t FROM documents)
SELECT source, min(doc_id) AS first, count(*) AS copies FROM n WHERE length(t) >= 80 GROUP BY source, t HAVING count(*) > 1""",
)
def exact_duplicate_docs(spark, d):
    n = docs(spark, d).select("source", "doc_id", X.norm(F.col("text")).alias("t")).where("char_length(t) >= 80")
    out = n.groupBy("source", F.sha2("t", 256).alias("h")).agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    return out.where("copies > 1").drop("h")


ENDINGS = [
    (1, "Stages are:", False, False), (2, "Stages are:", True, False), (3, "Stages are:", False, True), (4, "cut here ", False, False),
    (5, "The list —", False, True), (6, "short", False, False), (7, "short.", False, False), (8, "A fairly long sentence that goes on well past the bound of sixty characters without an end", False, False),
    (9, "", False, False), (10, None, True, True), (11, "bullet •\n", False, False), (12, "short", True, False),
]
_R = f"regexp_replace(coalesce(s, ''), {S.q(X._RUN + '$')}, '')"


@query(
    "truncation_cases",
    f"""WITH {S.values("src", "id, s, tab, img", ENDINGS)}, r AS (SELECT *, coalesce(s, '') AS raw, {_R} AS t FROM src)
SELECT id, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, {S.q(P.DANGLING_END)}) AND NOT (ends_with(t, ':') AND (tab OR img)) THEN 'truncated_solution'
  WHEN raw <> t AND regexp_matches(t, '[A-Za-z0-9]$') THEN 'truncated_solution'
  WHEN length(t) < 60 AND strpos({S.q(P.TERMINAL)}, right(t, 1)) = 0 AND NOT tab AND NOT img THEN 'short_bare_solution' END AS flag,
  regexp_matches(raw, ':\\s*$') AND NOT tab AS retry, NOT regexp_matches(raw, '[.!?]\\s*$') AS open FROM r""",
)
def truncation_cases(spark, d):
    df = S.inline(spark, "id int, s string, tab boolean, img boolean", ENDINGS)
    s, tab, img = F.col("s"), F.col("tab"), F.col("img")
    return df.select("id", X.truncation(s, tab, img).alias("flag"), X.retry_truncated(s, tab).alias("retry"), X.block_open(s).alias("open"))


CONTINUES = [
    (1, "Option C: x", "Option D: y", True), (2, "• one\n• two", "• three", True), (3, "the lens is", "thick and clear", True), (4, "It ends here.", "Another begins", False),
    (5, "Option A: x", "Option D: y", False), (6, "It ends.", "Option A: new", False), (7, "", "text", False), (8, "text", None, False),
]


@query("continuation_cases", f"WITH {S.values('src', 'id, a, b, want', CONTINUES)} SELECT id, want AS continues FROM src")
def continuation_cases(spark, d):
    df = S.inline(spark, "id int, a string, b string, want boolean", CONTINUES)
    return df.select("id", X.continues(F.col("a"), F.col("b")).alias("continues"))


DRIFT = [
    (1, "Give 60 mg daily for 3 weeks, then 1,200 mg at most in total.", "Dose: 60 mg daily; 3 weeks"), (2, "Give 60 mg daily for 3 weeks, as is usual in adults.", "60 mg, 3 weeks"),
    (3, "short 5 mg", "7 mg"), (4, "Give 60 mg daily for 3 weeks, as is usual in adults.", "no numbers on this page"), (5, "Give 2 Gy in 5 days and no more than that to anyone.", "2 cGy"),
]


def _numbers(x: str) -> str:
    # RE2 knows no Unicode word bound; the units here are ASCII on both sides
    return f"list_transform(list_distinct(regexp_extract_all(coalesce({x}, ''), {S.q(P.NUMBER_WITH_UNIT)}, 0)), lambda x: regexp_replace(x, '[ ,]', '', 'g'))"


@query(
    "unit_number_drift",
    f"""WITH {S.values("src", "id, solution, page", DRIFT)}, n AS (SELECT *, {_numbers("solution")} AS a, {_numbers("page")} AS b FROM src)
SELECT id, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ',') AS absent FROM n
WHERE length(solution) >= 40 AND len(b) > 0 AND len(list_filter(a, lambda x: NOT list_contains(b, x))) > 0""",
)
def unit_number_drift(spark, d):
    df = S.inline(spark, "id int, solution string, page string", DRIFT)
    df = df.withColumn("a", X.unit_numbers(F.col("solution"))).withColumn("b", X.unit_numbers(F.col("page")))
    absent = F.array_sort(F.array_except("a", "b"))
    return df.where((F.char_length("solution") >= P.DRIFT_MIN_LEN) & (F.size("b") > 0) & (F.size(absent) > 0)).select("id", F.array_join(absent, ",").alias("absent"))
