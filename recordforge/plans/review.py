"""Queries of ownership and review over events, orders, documents and labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.operators import ownership as O
from recordforge.operators import review as V

from . import sql as S
from .records import table
from .registry import query


@query(
    "asof_owner",
    """SELECT p.user_id, p.ts, p.event_id, s.event_id AS owner FROM (SELECT * FROM events WHERE event_type = 'purchase') p
LEFT JOIN LATERAL (SELECT event_id FROM events s WHERE s.event_type = 'signup' AND s.user_id = p.user_id AND (s.ts, s.event_id) <= (p.ts, p.event_id) ORDER BY s.ts DESC, s.event_id DESC LIMIT 1) s ON true""",
)
def asof_owner(spark, d):
    e = table(spark, d, "events")
    right = e.where("event_type = 'signup'").select("user_id", "ts", "event_id", F.col("event_id").alias("owner"))
    return O.as_of(e.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), right, "user_id", ["ts", "event_id"], ["owner"])


@query(
    "capped_claims",
    """WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS rank, l_returnflag = 'R' AS declared FROM lineitem)
SELECT l_orderkey, rank, declared, rank <= CASE WHEN declared THEN 8 ELSE 3 END AS kept FROM r""",
)
def capped_claims(spark, d):
    li = table(spark, d, "lineitem").withColumn("declared", F.col("l_returnflag") == "R")
    out = O.capped(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], 3, 8, "declared")
    return out.select("l_orderkey", "rank", "declared", "kept")


@query(
    "claim_totals",
    "WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) SELECT CAST(sum(least(n, 3)) AS BIGINT) AS kept, CAST(sum(n - least(n, 3)) AS BIGINT) AS leftover FROM n",
)
def claim_totals(spark, d):
    out = O.capped(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], 3, 8)
    return out.agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("leftover"))


@query(
    "page_range_lookup",
    """WITH c AS (SELECT n_regionkey AS book, n_nationkey AS chapter_no, n_nationkey * 40 + 1 AS start FROM nation),
r AS (SELECT book, chapter_no, start AS file_start, coalesce(lead(start) OVER (PARTITION BY book ORDER BY chapter_no) - 1, 2000) AS file_end FROM c)
SELECT p_partkey, book, chapter_no FROM part JOIN r ON p_partkey BETWEEN file_start AND file_end""",
)
def page_range_lookup(spark, d):
    c = table(spark, d, "nation").select(F.col("n_regionkey").alias("book"), F.col("n_nationkey").alias("chapter_no"), (F.col("n_nationkey") * 40 + 1).alias("start"))
    r = O.page_ranges(c, F.lit(2000))
    p = table(spark, d, "part").select("p_partkey")
    return O.in_range(p, r, "p_partkey", "file_start", "file_end").select("p_partkey", "book", "chapter_no")


@query("unclaimed", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)")
def unclaimed(spark, d):
    used = table(spark, d, "lineitem").where("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, d, "part").select("p_partkey").join(used, "p_partkey", "left_anti")


@query("shared_images", "SELECT l_partkey AS file, count(DISTINCT l_orderkey) AS owners FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1")
def shared_images(spark, d):
    """Images claimed by several owners: they refuse to move."""
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("file")).agg(F.count_distinct("l_orderkey").alias("owners")).where("owners > 1")


@query(
    "manifest",
    """SELECT l_orderkey AS q_id, 'question' AS type, l_partkey AS file FROM lineitem WHERE l_linenumber <= 3
UNION ALL SELECT l_orderkey, 'solution', l_suppkey FROM lineitem WHERE l_linenumber > 3""",
)
def manifest(spark, d):
    """One row for each reference: questions, then solutions; a view that can always be rebuilt."""
    li = table(spark, d, "lineitem")
    q = li.where("l_linenumber <= 3").select(F.col("l_orderkey").alias("q_id"), F.lit("question").alias("type"), F.col("l_partkey").alias("file"))
    return q.unionByName(li.where("l_linenumber > 3").select(F.col("l_orderkey").alias("q_id"), F.lit("solution").alias("type"), F.col("l_suppkey").alias("file")))


@query(
    "extents",
    """WITH h AS (SELECT user_id, ts, event_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until FROM events WHERE event_type = 'signup')
SELECT h.event_id AS heading, count(*) AS inside FROM h JOIN events e ON e.user_id = h.user_id AND e.event_type = 'view' AND e.ts >= h.ts AND (h.until IS NULL OR e.ts < h.until) GROUP BY 1""",
)
def extents(spark, d):
    """Items inside each heading's block, by as-of assignment."""
    e = table(spark, d, "events")
    heads = e.where("event_type = 'signup'").select("user_id", "ts", F.col("event_id").alias("heading"))
    owned = O.as_of(e.where("event_type = 'view'").select("user_id", "ts", "event_id"), heads, "user_id", ["ts"], ["heading"])
    return owned.where("heading is not null").groupBy("heading").agg(F.count("*").alias("inside"))


TOC = [(1, 1, 1, 5), (1, 2, 2, 9), (1, 3, 3, 20), (1, 4, 9, 25), (1, 5, 4, 30), (2, 1, 2, 5), (2, 2, 3, 6), (3, 1, 1, 5), (3, 2, 1, 7), (3, 3, 2, 9), (4, 1, 1, 9), (4, 2, 2, 3), (4, 3, 3, 12)]


@query(
    "toc_runs",
    f"""WITH RECURSIVE {S.values("t", "book, pos, no, page", TOC)},
r AS (SELECT book, min(pos) AS pos, 1 AS no FROM t WHERE no = 1 GROUP BY book
  UNION ALL SELECT r.book, (SELECT min(t.pos) FROM t WHERE t.book = r.book AND t.no = r.no + 1 AND t.pos > r.pos AND t.page >= (SELECT page FROM t u WHERE u.book = r.book AND u.pos = r.pos)), r.no + 1 FROM r
  WHERE EXISTS (SELECT 1 FROM t WHERE t.book = r.book AND t.no = r.no + 1 AND t.pos > r.pos AND t.page >= (SELECT page FROM t u WHERE u.book = r.book AND u.pos = r.pos)))
SELECT t.book, t.no, t.page FROM r JOIN t ON t.book = r.book AND t.pos = r.pos""",
)
def toc_runs(spark, d):
    return O.toc_run(S.inline(spark, "book int, pos int, no int, page int", TOC))


WINDOWS = [(1, 3, 16, 11), (2, 1, 30, 21), (3, 5, 9, None), (4, 7, 12, 7)]


@query(
    "section_windows",
    f"""WITH {S.values("t", "chapter, first, last, solutions", WINDOWS)},
q AS (SELECT chapter, first, 'Q' AS section, unnest(range(0, (solutions - 1 - first) // 10 + 1)) AS number, first AS a, solutions - 1 AS b, 10 AS size FROM t WHERE solutions > first),
s AS (SELECT chapter, first, 'S' AS section, unnest(range(0, (last - solutions) // 5 + 1)) AS number, solutions AS a, last AS b, 5 AS size FROM t WHERE solutions IS NOT NULL)
SELECT chapter, section, CAST(number AS INT) AS number, array_to_string(range(greatest(first, a + number * size - 1), least(b, a + number * size + size - 1) + 1), ',') AS pages FROM (SELECT * FROM q UNION ALL SELECT * FROM s)""",
)
def section_windows(spark, d):
    out = O.section_windows(S.inline(spark, "chapter int, first int, last int, solutions int", WINDOWS))
    return out.withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


PASSES = [("S", "Q", 0, False, True), ("S", "S", 0, False, True), ("S", "S", 9, False, True), ("S", "S", 9, True, True), ("S", "S", 0, True, False)]
_STATUS = ("EXPECTED_EMPTY", "PARTIAL", "SUCCESS", "RETRYABLE_FAILURE", "UNRESOLVED")
RUNS = [("S", False, None, False), ("S", True, None, False), ("S", False, 4, False), ("Q", False, None, False), ("Q", False, None, True)]


@query("pass_status", f"WITH {S.values('t', 'i, status', list(enumerate(_STATUS)))} SELECT i, status FROM t")
def pass_status(spark, d):
    df = S.inline(spark, "i int, section string, step string, items int, error boolean, recovered boolean", [(i, *r) for i, r in enumerate(PASSES)])
    return df.select("i", O.pass_status(*[F.col(c) for c in ("section", "step", "items", "error", "recovered")]).alias("status"))


@query("pass_activation", "SELECT * FROM (VALUES (0, FALSE), (1, TRUE), (2, TRUE), (3, TRUE), (4, FALSE)) t(i, run)")
def pass_activation(spark, d):
    df = S.inline(spark, "i int, section string, overlap boolean, carry int, boundary boolean", [(i, *r) for i, r in enumerate(RUNS)])
    return df.select("i", O.should_run_questions(*[F.col(c) for c in ("section", "overlap", "carry", "boundary")]).alias("run"))


@query(
    "figure_zip",
    """WITH n AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), m AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
a AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT o_custkey, o_orderkey AS found, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders WHERE o_orderstatus = 'O')
SELECT a.o_custkey, a.o_orderkey AS pos, b.found FROM a JOIN b USING (o_custkey, i) JOIN n USING (o_custkey) JOIN m USING (o_custkey) WHERE n.n = m.n""",
)
def figure_zip(spark, d):
    o = table(spark, d, "orders")
    a = o.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").alias("pos"))
    b = o.where("o_orderstatus = 'O'").select("o_custkey", F.col("o_orderkey").alias("pos"), F.col("o_orderkey").alias("found"))
    return O.zip_exact(a, b, "o_custkey", "pos").select("o_custkey", "pos", "found")


@query(
    "witness_diff",
    """SELECT id, 'audit_missing_question' AS kind FROM (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT') WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT id, 'audit_ghost_question' FROM (SELECT DISTINCT o_custkey AS id FROM orders WHERE o_orderstatus = 'P') WHERE id NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def witness_diff(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_custkey", "id")
    return O.witness(o.where("o_orderstatus = 'P'").select("id"), o.where("o_orderpriority = '1-URGENT'").select("id"), ["id"])


CASES = [(1, 0.99, True, False, "p", True), (2, 0.97, True, False, "p", True), (3, 0.99, True, True, "p", False), (4, 0.5, False, False, "p", False), (5, 0.0, True, False, "", False), (6, 0.96, True, False, "p", False), (7, 0.85, True, False, "p", False), (8, 0.1, True, False, "p", False)]


@query("adjudicate_cases", "SELECT * FROM (VALUES (1, 'auto'), (2, 'human'), (3, 'human'), (4, 'reject'), (5, 'human'), (6, 'auto'), (7, 'human'), (8, 'reject')) t(id, outcome)")
def adjudicate_cases(spark, d):
    df = S.inline(spark, "id int, score double, found boolean, truncated boolean, page string, duplicate boolean", CASES)
    return df.select("id", O.adjudicate(*[F.col(c) for c in ("score", "found", "truncated", "page", "duplicate")]).alias("outcome"))


PATCHES = [(1, {"A": "x", "D": None}, {"D": "the fourth choice"}), (2, {"A": "x", "D": "  "}, {"D": "the fourth choice"}), (3, {"A": "x", "D": "kept"}, {"D": "other"}), (4, {"A": "x"}, {"B": None})]


@query("option_patch", "SELECT * FROM (VALUES (1, 'A=x;D=the fourth choice'), (2, 'A=x;D=the fourth choice'), (3, 'A=x;D=kept'), (4, 'A=x')) t(id, options)")
def option_patch(spark, d):
    df = S.inline(spark, "id int, options map<string,string>, fix map<string,string>", PATCHES)
    new = O.patch_options(F.col("options"), F.col("fix"))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(new), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return df.select("id", text.alias("options"))


def _flags(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("q_id"), F.col("source").alias("chapter"), "lang", "n_chars")
    gate = docs.where("n_chars < 200").select(F.lit("incomplete_records").alias("kind"), "q_id", "chapter", F.concat(F.lit("short: "), F.col("n_chars").cast("string")).alias("detail"))
    integrity = docs.where("lang = 'de'").select(F.lit("answer_key_disagrees").alias("kind"), "q_id", "chapter", F.lit("language").alias("detail"))
    check = docs.where("lang in ('de', 'es')").select(F.when(F.col("lang") == "de", "answer_key_disagrees").otherwise("suspect_stem").alias("kind"), "q_id", "chapter", F.lit("language").alias("detail"))
    check = check.unionByName(check.where("q_id % 2 = 0"))  # the validator may say a thing twice
    return V.queue({"export_gate": gate, "integrity": integrity, "validator": check})


_KEY = "substr(sha1(concat_ws('|', kind, q_id, chapter, source, substr(sha1(substr(detail, 1, 400)), 1, 8))), 1, 16)"
_QUEUE = f"""d AS (SELECT CAST(doc_id AS VARCHAR) AS q_id, source AS chapter, lang, n_chars FROM documents),
u AS (SELECT 'incomplete_records' AS kind, q_id, chapter, 'short: ' || n_chars AS detail, 'export_gate' AS source FROM d WHERE n_chars < 200
  UNION ALL SELECT 'answer_key_disagrees', q_id, chapter, 'language', 'integrity' FROM d WHERE lang = 'de'
  UNION ALL SELECT DISTINCT CASE lang WHEN 'de' THEN 'answer_key_disagrees' ELSE 'suspect_stem' END, q_id, chapter, 'language', 'validator' FROM d WHERE lang IN ('de', 'es')),
fl AS (SELECT *, CASE WHEN kind = 'suspect_stem' THEN 'REVIEW' ELSE 'BLOCKER' END AS severity, {_KEY} AS flag_key FROM u)"""


@query("review_queue", f"WITH {_QUEUE} SELECT * FROM fl")
def review_queue(spark, d):
    return _flags(spark, d)


def _decided(spark, d):
    f = _flags(spark, d).withColumn("content_sig", K.signature(F.col("q_id"), F.col("detail")))
    lab = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("q_id"), "quality", "toxic")
    first = F.struct(F.lit(1).alias("pos"), F.when(F.col("quality") == 1, "approved").otherwise("reopened").alias("action"), F.lit(True).alias("same"))
    second = F.struct(F.lit(2).alias("pos"), F.when(F.col("toxic") == 1, "reopened").otherwise("approved").alias("action"), (F.col("q_id").cast("long") % 3 > 0).alias("same"))
    log = f.join(lab, "q_id").select("flag_key", "content_sig", F.explode(F.array(first, second)).alias("x"))
    log = log.select("flag_key", "x.pos", "x.action", F.when(F.col("x.same"), F.col("content_sig")).otherwise("old").alias("content_sig"))
    return V.overlay(f, log)


_DECIDED = f"""{_QUEUE}, ov AS (SELECT fl.*, CASE WHEN l.doc_id IS NULL OR toxic = 1 THEN 'open' WHEN l.doc_id % 3 = 0 THEN 'stale' ELSE 'closed' END AS state
  FROM fl LEFT JOIN labels l ON CAST(l.doc_id AS VARCHAR) = fl.q_id)"""


@query("decision_overlay", f"WITH {_DECIDED} SELECT flag_key, q_id, kind, state FROM ov")
def decision_overlay(spark, d):
    return _decided(spark, d).select("flag_key", "q_id", "kind", "state")


@query("queue_cards", f"WITH {_QUEUE} SELECT q_id AS entity, min(severity) AS severity, array_to_string(list_sort(list_distinct(list(kind))), ',') AS kinds, count(*) AS flags FROM fl GROUP BY 1")
def queue_cards(spark, d):
    return V.cards(_flags(spark, d))


@query("final_gate", f"WITH {_DECIDED} SELECT count(*) FILTER (state <> 'closed') AS open, count(*) FILTER (state <> 'closed' AND severity = 'BLOCKER') AS blockers, count(*) FILTER (state <> 'closed') > 0 AS locked FROM ov")
def final_gate(spark, d):
    return V.gate(_decided(spark, d))


@query("review_page", f"WITH {_QUEUE}, o AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY severity, q_id, kind, source) AS r FROM fl) SELECT chapter, r, flag_key FROM o WHERE r BETWEEN 1 AND 25")
def review_page(spark, d):
    """The first page of each chapter's open flags (a page is the feature)."""
    from pyspark.sql import Window

    w = Window.partitionBy("chapter").orderBy("severity", "q_id", "kind", "source")
    return _flags(spark, d).withColumn("r", F.row_number().over(w)).where("r between 1 and 25").select("chapter", "r", "flag_key")


@query(
    "sampled_back",
    """SELECT doc_id, substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16) AS k FROM documents
WHERE list_reduce(list_prepend(0, list_transform(range(1, 17), lambda i: CAST(strpos('0123456789abcdef', substr(substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16), i, 1)) - 1 AS BIGINT))), lambda a, b: (a * 16 + b) % 15) = 0""",
)
def sampled_back(spark, d):
    k = F.substring(F.sha1(F.col("doc_id").cast("string")), 1, 16)
    return table(spark, d, "documents").select("doc_id", k.alias("k")).where(K.sampled(F.col("k")))


FILES = [("questions.jsonl",), ("export_gate.jsonl",), ("dropped_anchorless.jsonl",), ("fix_output_archive.jsonl",), ("orphans.jsonl",)]


@query("watchdog", "SELECT name, 'watchdog_unregistered_file' AS kind, 'BLOCKER' AS severity FROM (VALUES ('dropped_anchorless.jsonl'), ('fix_output_archive.jsonl')) t(name)")
def watchdog(spark, d):
    return V.watchdog(S.inline(spark, "name string", FILES))


@query(
    "quota_replay",
    """WITH e AS (SELECT user_id AS key, ts, event_id AS id, event_type = 'error' OR event_type = 'signup' AS burst, strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d') AS day FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY key, day ORDER BY ts, id) AS used FROM e)
SELECT key, id, day, used, used > 5 AS over_cap, EXISTS (SELECT 1 FROM e b WHERE b.key = r.key AND b.burst AND b.ts < r.ts AND b.ts >= r.ts - INTERVAL 3600 SECOND) AS cooling FROM r""",
)
def quota_replay(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("id"), F.col("event_type").isin("error", "signup").alias("burst"))
    return V.replay_quota(e, cap=5, cooldown=3600).select("key", "id", "day", "used", "over_cap", "cooling")


@query("day_stamp", "SELECT strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d') AS day, count(*) AS calls FROM events GROUP BY 1")
def day_stamp(spark, d):
    return table(spark, d, "events").groupBy(K.day_stamp(F.col("ts")).alias("day")).agg(F.count("*").alias("calls"))


@query("quota_remaining", "SELECT CAST(sum(greatest(0, 80 - n)) AS BIGINT) AS remaining FROM (SELECT count(*) AS n FROM events GROUP BY user_id)")
def quota_remaining(spark, d):
    n = table(spark, d, "events").groupBy("user_id").count()
    return n.agg(F.sum(F.greatest(F.lit(0), 80 - F.col("count"))).alias("remaining"))


@query(
    "carry_sessions",
    """SELECT conv_id, turn, last_value(CASE WHEN NOT regexp_matches(text, '[.!?]\\s*$') THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS carried FROM conversations""",
)
def carry_sessions(spark, d):
    c = table(spark, d, "conversations")
    return V.carry(c, "conv_id", "turn", ~F.col("text").rlike(r"[.!?]\s*$")).select("conv_id", "turn", "carried")


VERDICTS = [(1, False, "high", True, "0000000000000001"), (2, False, "medium", True, "0000000000000001"), (3, True, "high", True, "0000000000000001"), (4, False, "high", False, "0000000000000001"), (5, False, "high", True, "000000000000000f")]


@query("verification", "SELECT * FROM (VALUES (1, 'closed'), (2, 'open'), (3, 'open'), (4, 'open'), (5, 'sampled_back')) t(id, outcome)")
def verification(spark, d):
    df = S.inline(spark, "id int, genuine boolean, confidence string, parsed boolean, k string", VERDICTS)
    return df.select("id", V.verification(*[F.col(c) for c in ("genuine", "confidence", "parsed", "k")]).alias("outcome"))
