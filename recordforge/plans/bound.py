"""Operators bound to the driver's whole tables, each with a twin that computes its result in SQL.

Their stated cases, in the other modules, are run by the tests.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X
from recordforge.operators import edits as E
from recordforge.operators import fields as O
from recordforge.operators import healing as H
from recordforge.operators import merging as M
from recordforge.operators import ownership as W
from recordforge.operators import records as R
from recordforge.operators import review as V

from . import sql as S
from .evidence import REST, STEM, split_text
from .records import _BL, table
from .registry import query

NL = "chr(10)"
#: A record for each document: some fields are missing by its id.
_REC = f"""rec AS (SELECT doc_id AS id, CASE WHEN doc_id % 2 = 0 THEN {STEM} END AS stem, CASE WHEN doc_id % 5 > 0 THEN lang END AS options,
  CASE WHEN doc_id % 3 = 0 THEN source END AS answer, {REST} AS solution, n_chars FROM documents)"""


def s(c):
    return c.cast("string")


def _records(spark, d):
    r = split_text(table(spark, d, "documents"))
    i = F.col("doc_id")
    return r.select(i.alias("id"), F.when(i % 2 == 0, F.col("stem")).alias("stem"), F.when(i % 5 > 0, F.col("lang")).alias("options"), F.when(i % 3 == 0, F.col("source")).alias("answer"), "solution", "n_chars")


@query("anchorless", f"WITH {_REC} SELECT id, {_BL('stem')} AND {_BL('solution')} AND id % 4 IN (0, 1) AS anchorless FROM rec")
def anchorless(spark, d):
    none = F.lit(None).cast("map<string,string>")
    options = F.when(F.col("id") % 4 == 0, none).when(F.col("id") % 4 == 1, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("A"), F.lit("x")))
    return _records(spark, d).withColumn("options", options).select("id", O.anchorless().alias("anchorless"))


@query(
    "available_passes",
    f"""WITH {_REC} SELECT id, array_to_string(list_filter([CASE WHEN NOT {_BL("options")} THEN 'Q_PASS=options' WHEN NOT {_BL("stem")} THEN 'Q_PASS=stem' END,
  CASE WHEN NOT {_BL("answer")} THEN 'A_PASS=answer' END, CASE WHEN NOT {_BL("solution")} THEN 'S_PASS=solution' END], lambda x: x IS NOT NULL), ';') AS passes FROM rec""",
)
def available_passes(spark, d):
    entries = F.transform(F.map_entries(O.available_passes()), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return _records(spark, d).select("id", F.array_join(entries, ";").alias("passes"))


@query(
    "orphan_view",
    f"""WITH {_REC} SELECT id AS orphan, substr(CASE WHEN NOT {_BL("stem")} THEN stem WHEN NOT {_BL("options")} THEN options WHEN NOT {_BL("answer")} THEN answer WHEN NOT {_BL("solution")} THEN solution END, 1, 600) AS snippet,
  array_to_string(list_sort(list_distinct([id % 7, id % 5])), ',') AS pages FROM rec""",
)
def orphan_view(spark, d):
    page = lambda n: (F.col("id") % n).cast("int")
    r = _records(spark, d).withColumn("orphan", F.col("id")).withColumn("pages", F.array(page(7), page(5), page(7)))
    return O.orphan_view(r).withColumn("pages", F.array_join(F.col("pages").cast("array<string>"), ","))


@query("evidence_field", f"WITH {_REC} SELECT id, CASE WHEN NOT {_BL('solution')} THEN solution WHEN NOT {_BL('stem')} THEN stem WHEN NOT {_BL('options')} THEN options WHEN NOT {_BL('answer')} THEN answer END AS value FROM rec")
def evidence_field(spark, d):
    return _records(spark, d).select("id", O.evidence_field().alias("value"))


@query(
    "qa_status",
    f"""WITH {_REC}, r AS (SELECT id, list_filter([CASE WHEN {_BL("stem")} THEN 'missing_stem' END, CASE WHEN id % 6 <> 4 THEN 'bad_options' END, CASE WHEN {_BL("answer")} THEN 'missing_answer' END,
  CASE WHEN {_BL("solution")} THEN 'missing_solution' END], lambda x: x IS NOT NULL) AS hard, list_filter([CASE WHEN n_chars % 2 = 0 THEN 'model_only_image' END, CASE WHEN n_chars % 3 = 0 THEN 'gate_notice' END,
  CASE WHEN n_chars % 5 = 0 THEN 'answer_flip' END], lambda x: x IS NOT NULL) AS soft FROM rec)
SELECT id, CASE WHEN len(hard) > 0 THEN 'INCOMPLETE' WHEN len(soft) > 0 THEN 'REVIEW_NEEDED' ELSE 'READY' END AS qa_status, array_to_string(list_concat(hard, soft), ',') AS qa_reasons FROM r""",
)
def qa_status(spark, d):
    r = _records(spark, d).withColumn("options", (F.col("id") % 6).cast("int"))
    r = r.withColumns({n: F.coalesce(F.col("n_chars") % k == 0, F.lit(False)) for n, k in (("model_only_image", 2), ("gate_notice", 3), ("answer_flip", 5))})
    return M.qa_status(r).select("id", "qa_status", "qa_reasons")


@query(
    "export_gate",
    f"""WITH {_REC}, k AS (SELECT id, unnest([CASE WHEN {_BL("stem")} THEN 'missing_stem' END, CASE WHEN {_BL("answer")} THEN 'missing_answer' END, CASE WHEN {_BL("solution")} THEN 'missing_solution' END,
  CASE WHEN id % 6 <> 4 THEN 'bad_options' END, CASE WHEN n_chars % 3 > 0 THEN 'broken_asset_ref' END]) AS kind FROM rec)
SELECT CAST(id AS INT) AS q_no, kind FROM k WHERE kind IS NOT NULL UNION ALL SELECT NULL, 'orphan_unresolved' FROM conversations WHERE turn % 3 = 0 AND NOT {_BL("text")}""",
)
def export_gate(spark, d):
    r = _records(spark, d).withColumn("options", F.array_repeat(F.lit("x"), (F.col("id") % 6).cast("int"))).withColumn("broken", F.col("n_chars") % 3)
    return O.export_gate(r.withColumn("q_no", F.col("id").cast("int")), table(spark, d, "conversations").where("turn % 3 = 0").select(F.col("text").alias("value")))


@query("option_path", "SELECT doc_id, source AS before, upper(source) || '!' AS after, lang AS other FROM documents")
def option_path(spark, d):
    o = lambda k, c: F.struct(F.lit(k).alias("id"), F.col(c).alias("text"))
    r = table(spark, d, "documents").select("doc_id", "source", F.array(o("A", "lang"), o("B", "source")).alias("options"))
    r = r.select("doc_id", O.get_option("B").alias("before"), O.set_option("B", F.concat(F.upper("source"), F.lit("!"))).alias("options"))
    return r.select("doc_id", "before", O.get_option("B").alias("after"), O.get_option("A").alias("other"))


_FILES = "['page-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0') || '.jpg', p_name, 'img-' || p_size || '.png', 'cover.jpg']"


@query("window_pages", rf"SELECT p_partkey AS id, array_to_string(list_transform(list_filter({_FILES}, lambda f: regexp_matches(f, '-(\d+)\.')), lambda f: CAST(regexp_extract(f, '-(\d+)\.', 1) AS INT)), ',') AS pages FROM part")
def window_pages(spark, d):
    files = F.array(F.concat(F.lit("page-"), F.lpad(s(F.col("p_partkey") % 1000), 3, "0"), F.lit(".jpg")), F.col("p_name"), F.concat(F.lit("img-"), s(F.col("p_size")), F.lit(".png")), F.lit("cover.jpg"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.array_join(O.page_numbers(files).cast("array<string>"), ",").alias("pages"))


_DETAIL = "'lost S/S-p' || o_orderkey || '-' || (o_custkey % 9) || '.webp, X/X-00' || (o_custkey % 10) || '-0' || (10 + o_custkey % 80) || '_Q_0' || (o_custkey % 10) || '.webp; ' || o_orderpriority"


@query("image_names", f"SELECT o_orderkey AS id, array_to_string(regexp_extract_all({_DETAIL}, {S.q(O.IMAGE_NAME)}), ',') AS names FROM orders")
def image_names(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    detail = F.concat(F.lit("lost S/S-p"), s(k), F.lit("-"), s(c % 9), F.lit(".webp, X/X-00"), s(c % 10), F.lit("-0"), s(10 + c % 80), F.lit("_Q_0"), s(c % 10), F.lit(".webp; "), F.col("o_orderpriority"))
    return table(spark, d, "orders").select(k.alias("id"), F.array_join(O.image_names(detail), ",").alias("names"))


@query(
    "pick_pages",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey || ',' || (o_custkey + 1) WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS pages FROM orders""",
)
def pick_pages(spark, d):
    k, c = F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int")
    named = F.when(k % 3 == 0, F.array().cast("array<int>")).otherwise(F.array(c, c + 1, c + 2))
    own = F.when(k % 2 == 0, F.array(k))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.array_join(O.pick_pages(named, own).cast("array<string>"), ",").alias("pages"))


_LETTERS = f"coalesce('Option ' || chr(CAST(65 + turn % 6 AS INT)) || ': ' || text || {NL} || ' option ' || chr(CAST(97 + conv_id % 5 AS INT)) || '. x', '')"


@query("option_letters", rf"SELECT conv_id, turn, upper(array_to_string(regexp_extract_all({_LETTERS}, '(?mi)^\s*Option\s+([A-D])\b', 1), '')) AS letters FROM conversations")
def option_letters(spark, d):
    text = F.concat(F.lit("Option "), F.char(65 + F.col("turn") % 6), F.lit(": "), F.col("text"), F.lit("\n option "), F.char(97 + F.col("conv_id") % 5), F.lit(". x"))
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(O.option_letters(text), "").alias("letters"))


@query(
    "quota_errors",
    """WITH m AS (SELECT event_id AS id, lower(coalesce(CASE event_id % 5 WHEN 0 THEN '429 GenerateRequestsPerDay ' || user_id WHEN 1 THEN 'Quota EXHAUSTED' WHEN 2 THEN event_type WHEN 3 THEN 'Daily limit of ' || user_id ELSE props END, '')) AS m FROM events)
SELECT id, CASE WHEN regexp_matches(m, 'per.?day|daily|requestsperday') THEN 'day' WHEN regexp_matches(m, '429|quota|rate|exhausted') THEN 'burst' END AS kind FROM m""",
)
def quota_errors(spark, d):
    k, u = F.col("event_id") % 5, s(F.col("user_id"))
    m = F.when(k == 0, F.concat(F.lit("429 GenerateRequestsPerDay "), u)).when(k == 1, "Quota EXHAUSTED").when(k == 2, F.col("event_type")).when(k == 3, F.concat(F.lit("Daily limit of "), u)).otherwise(F.col("props"))
    return table(spark, d, "events").select(F.col("event_id").alias("id"), O.quota_error(m).alias("kind"))


@query(
    "repaired_json",
    """WITH j AS (SELECT p_partkey AS id, CASE p_partkey % 3 WHEN 0 THEN '{"a": ' || p_size || '}' WHEN 1 THEN '{''a'': ' || p_size || '}' ELSE p_name END AS j FROM part),
k AS (SELECT id, CASE WHEN json_valid(j) THEN j WHEN json_valid(replace(j, '''', '"')) THEN replace(j, '''', '"') END AS j FROM j)
SELECT id, CAST(json_extract_string(j, '$.a') AS INT) AS a FROM k""",
)
def repaired_json(spark, d):
    k, n = F.col("p_partkey") % 3, s(F.col("p_size"))
    j = F.when(k == 0, F.concat(F.lit('{"a": '), n, F.lit("}"))).when(k == 1, F.concat(F.lit("{'a': "), n, F.lit("}"))).otherwise(F.col("p_name"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), O.repaired_json(j, "a int")["a"].alias("a"))


@query(
    "toc_scan",
    rf"""WITH p AS (SELECT l_suppkey AS book, CAST(1 + l_orderkey % 45 AS INT) AS page, l_partkey, l_linenumber, l_returnflag FROM lineitem),
x AS (SELECT book, page, greatest(0, CAST(ceil((page - {P.TOC_FIRST}) / {P.TOC_STEP}.0) AS INT)) AS batch,
  CASE WHEN l_returnflag = 'A' AND (page <= 12 OR book % 2 = 0 AND page < 20) THEN ' ' || l_linenumber || '. Part of ' || l_partkey || ' .... ' || (l_partkey % 900) ELSE 'prose ' || l_partkey || ' here' END AS t FROM p WHERE page <= {P.TOC_CAP}),
m AS (SELECT *, regexp_matches(t, {S.q(O.TOC_LINE)}) AS hit FROM x),
b AS (SELECT book, batch, count(*) FILTER (hit) AS n FROM m GROUP BY ALL),
live AS (SELECT book, batch FROM b WHERE NOT EXISTS (SELECT 1 FROM b e WHERE e.book = b.book AND e.batch <= b.batch AND e.n = 0))
SELECT book, page, CAST(regexp_extract(t, {S.q(O.TOC_LINE)}, 1) AS INT) AS no, regexp_extract(t, {S.q(O.TOC_LINE)}, 2) AS title, CAST(regexp_extract(t, {S.q(O.TOC_LINE)}, 3) AS INT) AS start
FROM m JOIN live USING (book, batch) WHERE hit""",
)
def toc_scan(spark, d):
    page = (1 + F.col("l_orderkey") % 45).cast("int")
    line = F.concat(F.lit(" "), s(F.col("l_linenumber")), F.lit(". Part of "), s(F.col("l_partkey")), F.lit(" .... "), s(F.col("l_partkey") % 900))
    on = (F.col("l_returnflag") == "A") & ((page <= 12) | ((F.col("l_suppkey") % 2 == 0) & (page < 20)))
    text = F.when(on, line).otherwise(F.concat(F.lit("prose "), s(F.col("l_partkey")), F.lit(" here")))
    return O.toc_scan(table(spark, d, "lineitem").select(F.col("l_suppkey").alias("book"), page.alias("page"), text.alias("text")))


@query(
    "auto_resolved",
    """SELECT l_orderkey AS flag_key FROM lineitem GROUP BY 1
HAVING bool_and(l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40) AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 11 > 0))""",
)
def auto_resolved(spark, d):
    name = lambda c, n: F.concat(F.lit("S/S-p"), s(F.col(c)), F.lit(f"-{n}.webp"))
    flags = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("flag_key"), F.concat(F.lit("lost "), name("l_partkey", 1), F.lit(" and "), name("l_suppkey", 2)).alias("detail"))
    owned = table(spark, d, "part").where("p_size <= 40").select(name("p_partkey", 1).alias("file")).union(table(spark, d, "supplier").where("s_suppkey % 11 > 0").select(name("s_suppkey", 2)))
    return O.auto_resolved(flags, owned)


@query(
    "false_figures",
    """WITH real AS (SELECT DISTINCT p_partkey % 10 AS doc, p_partkey // 10 % 50 AS page FROM part WHERE p_size % 2 = 1 AND p_size * 1000 > 30000)
SELECT o_orderkey AS flag_key FROM orders WHERE NOT EXISTS (SELECT 1 FROM real WHERE doc = o_custkey % 10 AND page IN (o_orderkey % 50, (o_orderkey + 1) % 50))""",
)
def false_figures(spark, d):
    k = F.col("o_orderkey")
    flags = table(spark, d, "orders").select(k.alias("flag_key"), (F.col("o_custkey") % 10).alias("doc"), F.array(k % 50, (k + 1) % 50).alias("pages"))
    images = table(spark, d, "part").select((F.col("p_partkey") % 10).alias("doc"), (F.floor(F.col("p_partkey") / 10) % 50).alias("page"), (F.col("p_size") % 2 == 0).alias("watermark"), (F.col("p_size") * 1000).alias("pixels"))
    return O.false_figures(flags, images)


@query(
    "image_aliases",
    """WITH n AS (SELECT substr('tfz', CAST(p_partkey % 3 + 1 AS INT), 1) || p_partkey AS name, p_partkey FROM part),
l AS (SELECT 't' || p_partkey AS name, 'f' || p_partkey AS final_file FROM part WHERE p_size > 10),
r AS (SELECT 'f' || p_partkey AS file, 'q' || p_brand AS q_id FROM part WHERE p_size < 40)
SELECT n.name, coalesce(final_file, n.name) AS final, q_id FROM n LEFT JOIN l USING (name) LEFT JOIN r ON r.file = coalesce(final_file, n.name)""",
)
def image_aliases(spark, d):
    p = table(spark, d, "part")
    k = s(F.col("p_partkey"))
    names = p.select(F.concat(F.substring(F.lit("tfz"), (F.col("p_partkey") % 3 + 1).cast("int"), F.lit(1)), k).alias("name"))
    ledger = p.where("p_size > 10").select(F.concat(F.lit("t"), k).alias("file"), F.concat(F.lit("f"), k).alias("final_file"))
    return O.aliases(names, ledger, p.where("p_size < 40").select(F.concat(F.lit("f"), k).alias("file"), F.concat(F.lit("q"), F.col("p_brand")).alias("q_id")))


_LINES = "li AS (SELECT l_orderkey AS chapter, l_linenumber AS id, min(l_returnflag) AS flag, max(l_partkey) AS part FROM lineitem GROUP BY ALL)"


@query(
    "chapter_patches",
    f"""WITH {_LINES}, r AS (SELECT chapter, id, CASE flag WHEN 'A' THEN ' ' WHEN 'R' THEN NULL ELSE 'v' || part END AS value FROM li),
p AS (SELECT chapter, id + CASE WHEN part % 8 = 2 THEN 100 ELSE 0 END AS id, CASE part % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'fill' ELSE 'insert' END AS action, 'p' || part AS new
  FROM li WHERE chapter IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')),
k AS (SELECT r.*, f.new, trim(coalesce(value, '')) = '' AND f.new IS NOT NULL AS use FROM r LEFT JOIN p f ON f.action = 'fill' AND f.chapter = r.chapter AND f.id = r.id
  WHERE NOT EXISTS (SELECT 1 FROM p g WHERE g.action = 'delete' AND g.chapter = r.chapter AND g.id = r.id))
SELECT chapter, id, CASE WHEN use THEN new ELSE value END AS value, CASE WHEN use THEN 'filled' ELSE 'kept' END AS change FROM k
UNION ALL SELECT chapter, id, new, 'inserted' FROM p WHERE action = 'insert' AND NOT EXISTS (SELECT 1 FROM r WHERE r.chapter = p.chapter AND r.id = p.id)""",
)
def chapter_patches(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("id")).agg(F.min("l_returnflag").alias("flag"), F.max("l_partkey").alias("part"))
    rows = li.select("chapter", "id", F.when(F.col("flag") == "A", " ").when(F.col("flag") == "N", F.concat(F.lit("v"), s(F.col("part")))).alias("value"))
    part = F.col("part")
    action = F.when(part % 4 == 0, "delete").when(part % 4 == 1, "fill").otherwise("insert")
    patches = li.select("chapter", (F.col("id") + F.when(part % 8 == 2, 100).otherwise(0)).alias("id"), action.alias("action"), F.concat(F.lit("p"), s(part)).alias("value"))
    gate = table(spark, d, "orders").select(F.col("o_orderkey").alias("chapter"), (F.col("o_orderstatus") == "F").alias("ok"))
    return O.apply_patches(rows, patches, gate)


@query(
    "carry_owner",
    """WITH c AS (SELECT DISTINCT l_orderkey AS chapter, CASE WHEN l_returnflag = 'A' THEN 'question' ELSE 'solution' END AS kind, l_linenumber AS q_no, CAST(l_quantity AS INT) AS p FROM lineitem)
SELECT chapter, kind, q_no FROM c QUALIFY row_number() OVER (PARTITION BY chapter ORDER BY p DESC, kind = 'question' DESC, q_no DESC) = 1""",
)
def carry_owner(spark, d):
    kind = F.when(F.col("l_returnflag") == "A", "question").otherwise("solution")
    return O.carry_owner(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), kind.alias("kind"), F.col("l_linenumber").alias("q_no"), F.col("l_quantity").cast("int").alias("ending_page")))


_PATH = "CASE page_id % 4 WHEN 0 THEN '_archive/' WHEN 1 THEN 'a/_archive/' WHEN 2 THEN 'x_archive/' ELSE '' END || page_id || CASE page_id % 3 WHEN 0 THEN '.bak-1' WHEN 1 THEN '.zip' ELSE '.jsonl' END"


@query("zip_skip", f"WITH p AS (SELECT page_id, {_PATH} AS path FROM pages) SELECT page_id, path, starts_with(path, '_archive/') OR contains(path, '/_archive/') OR contains(path, '.bak-') OR ends_with(path, '.zip') AS skipped FROM p")
def zip_skip(spark, d):
    k = F.col("page_id")
    lead = F.when(k % 4 == 0, "_archive/").when(k % 4 == 1, "a/_archive/").when(k % 4 == 2, "x_archive/").otherwise("")
    path = F.concat(lead, s(k), F.when(k % 3 == 0, ".bak-1").when(k % 3 == 1, ".zip").otherwise(".jsonl"))
    return table(spark, d, "pages").select("page_id", path.alias("path")).withColumn("skipped", O.zip_skipped(F.col("path")))


_TABLE = f"""CASE o_custkey % 4 WHEN 0 THEN '| a |' WHEN 1 THEN '| a | b |' || {NL} || '| 1 | ' || o_orderkey || ' |' WHEN 2 THEN '| a | b |' || {NL} || '|---|---|' || {NL} || '| ' || o_orderkey || ' |'
  ELSE '| a | b |' || {NL} || ' |---|:---| ' || {NL} || {NL} || '| ' || o_orderkey || ' | ' || o_orderpriority || ' |' END"""
_TABLE_ERROR = r"""CASE WHEN len(rows) < 2 THEN 'too few lines' WHEN NOT regexp_matches(rows[2], '^\|?[\s:|-]*---[\s:|-]*$') THEN 'no separator'
  WHEN len(list_distinct(list_transform(rows, lambda x: len(string_split(x, '|'))))) > 1 THEN 'uneven columns' END"""
_ROWS = f"list_filter(list_transform(string_split(coalesce(md, ''), {NL}), lambda x: trim(x)), lambda x: x <> '') AS rows"


def _table_of():
    k, c = s(F.col("o_orderkey")), F.col("o_custkey") % 4
    two = F.concat(F.lit("| a | b |\n| 1 | "), k, F.lit(" |"))
    uneven = F.concat(F.lit("| a | b |\n|---|---|\n| "), k, F.lit(" |"))
    good = F.concat(F.lit("| a | b |\n |---|:---| \n\n| "), k, F.lit(" | "), F.col("o_orderpriority"), F.lit(" |"))
    return F.when(c == 0, "| a |").when(c == 1, two).when(c == 2, uneven).otherwise(good)


@query("table_guard", f"WITH t AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 > 0 THEN {_TABLE} END AS md FROM orders), l AS (SELECT id, {_ROWS} FROM t) SELECT id, {_TABLE_ERROR} AS error FROM l")
def table_guard(spark, d):
    md = F.when(F.col("o_orderkey") % 7 > 0, _table_of())
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), MD.table_error(md).alias("error"))


@query(
    "edit_guard",
    f"""WITH t AS (SELECT o_orderkey AS id, ['stem', 'option', 'answer', 'solution', 'table', 'title'][o_orderkey % 6 + 1] AS field, chr(CAST(65 + o_custkey % 6 AS INT)) AS letter,
  CASE o_orderkey % 6 WHEN 4 THEN {_TABLE} ELSE chr(CAST(65 + o_custkey % 5 AS INT)) END AS md FROM orders), l AS (SELECT *, {_ROWS} FROM t)
SELECT id, CASE WHEN field = 'title' THEN 'field' WHEN field = 'option' AND letter NOT IN ('A', 'B', 'C', 'D') THEN 'letter' WHEN field = 'answer' AND md NOT IN ('A', 'B', 'C', 'D') THEN 'answer' WHEN field = 'table' THEN {_TABLE_ERROR} END AS error FROM l""",
)
def edit_guard(spark, d):
    k = F.col("o_orderkey") % 6
    field = F.get(F.array(*map(F.lit, ("stem", "option", "answer", "solution", "table", "title"))), k.cast("int"))
    value = F.when(k == 4, _table_of()).otherwise(F.char(65 + F.col("o_custkey") % 5))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), E.edit_error(field, F.char(65 + F.col("o_custkey") % 6), value).alias("error"))


_ESC = lambda x: f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


@query(
    "table_html",
    f"""SELECT p_partkey AS id, '<table><tr><th>name</th><th>size</th></tr><tr><td>' || {_ESC("p_name || ' < ' || p_brand")} || '</td><td>' || {_ESC("p_size || ' & more'")} || '</td></tr></table>' AS html FROM part""",
)
def table_html(spark, d):
    md = F.concat(F.lit("| name | size |\n|---|---|\n|  "), F.col("p_name"), F.lit(" < "), F.col("p_brand"), F.lit(" | "), s(F.col("p_size")), F.lit(" & more |"))
    return table(spark, d, "part").select(F.col("p_partkey").alias("id"), E.to_html(md).alias("html"))


@query(
    "image_operations",
    """WITH w AS (SELECT 'f' || c_custkey % 1000 AS file, 'q' || c_custkey % 7 AS q_id FROM customer), n AS (SELECT file, count(DISTINCT q_id) AS n FROM w GROUP BY 1),
o AS (SELECT o_orderkey AS op_id, ['attach', 'detach', 'move', 'burn'][o_orderkey % 4 + 1] AS op, 'f' || o_custkey % 1100 AS file, 'c' || o_custkey % 3 AS chapter, 'q' || (o_custkey % 1100) % 7 AS from_id, 'c' || o_orderkey % 3 AS to_chapter FROM orders)
SELECT op_id, CASE WHEN op = 'burn' THEN 'operation' WHEN op <> 'attach' AND coalesce(n > 1, false) THEN 'shared'
  WHEN op <> 'attach' AND NOT EXISTS (SELECT 1 FROM w WHERE w.file = o.file AND w.q_id = o.from_id) THEN 'not the owner' WHEN op = 'move' AND chapter <> to_chapter THEN 'other chapter' END AS error
FROM o LEFT JOIN n USING (file)""",
)
def image_operations(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    tag = lambda t, x: F.concat(F.lit(t), s(x))
    op = F.get(F.array(*map(F.lit, ("attach", "detach", "move", "burn"))), (k % 4).cast("int"))
    ops = table(spark, d, "orders").select(k.alias("op_id"), op.alias("op"), tag("f", c % 1100).alias("file"), tag("c", c % 3).alias("chapter"), tag("q", c % 1100 % 7).alias("from_id"), F.lit("q0").alias("to_id"), tag("c", k % 3).alias("to_chapter"))
    u = F.col("c_custkey")
    return E.image_op_error(ops, table(spark, d, "customer").select(tag("f", u % 1000).alias("file"), tag("q", u % 7).alias("q_id")))


_KINDS = ("empty_question", "contaminated_question", "suspect_stem", "missing_answer", "answer_mismatch", "missing_solution", "truncated_solution", "short_bare_solution", "bad_options", "blank_correct_option", "numbering_gap")
_FILLS = "CASE WHEN i < 3 THEN 'stem' WHEN i < 5 THEN 'answer' WHEN i < 8 THEN 'solution' WHEN i < 10 THEN 'options' END"


@query("merge_items", f"WITH k AS (SELECT o_orderkey AS id, o_orderkey % {len(_KINDS)} AS i, o_orderpriority AS v FROM orders) SELECT id, {_FILLS} AS field, CASE WHEN i < 10 THEN v END AS value FROM k")
def merge_items(spark, d):
    kind = F.get(F.array(*map(F.lit, _KINDS)), (F.col("o_orderkey") % len(_KINDS)).cast("int"))
    return E.merge_item(table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), kind.alias("kind"), F.col("o_orderpriority").alias("value")))


@query(
    "image_caps",
    f"""SELECT l_orderkey AS id, l_partkey AS file, CASE WHEN l_returnflag = 'A' THEN least({P.CEILING_QUESTION}, greatest({P.SOFT_CAP_QUESTION}, coalesce(nullif(CAST(l_quantity AS INT) % 12, 0), 0)))
  ELSE least({P.CEILING_SOLUTION}, greatest({P.SOFT_CAP_SOLUTION}, coalesce(nullif(CAST(l_quantity AS INT) % 12, 0), 0))) END AS cap FROM lineitem""",
)
def image_caps(spark, d):
    n = F.nullif(F.col("l_quantity").cast("int") % 12, F.lit(0))
    side = F.when(F.col("l_returnflag") == "A", "question").otherwise("solution")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("file"), E.image_cap(side, n).alias("cap"))


@query(
    "adjudicate_cases",
    f"""WITH c AS (SELECT l_orderkey AS id, l_partkey AS part, l_quantity / 50 AS s, l_returnflag <> 'N' AS found, l_linenumber = 3 AS cut, CASE WHEN l_linenumber = 1 THEN '' ELSE 'p' END AS page, l_linenumber = 2 AS dup FROM lineitem)
SELECT id, part, CASE WHEN dup AND s >= {P.DELETE_AUTO_MIN} THEN 'auto' WHEN dup OR cut THEN 'human' WHEN NOT found THEN 'reject' WHEN page = '' THEN 'human' WHEN s >= {P.AUTO_APPLY_MIN} THEN 'auto' WHEN s >= {P.HUMAN_QUEUE_MIN} THEN 'human' ELSE 'reject' END AS outcome FROM c""",
)
def adjudicate_cases(spark, d):
    n = F.col("l_linenumber")
    out = W.adjudicate(F.col("l_quantity") / 50, F.col("l_returnflag") != "N", n == 3, F.when(n == 1, "").otherwise("p"), n == 2)
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), out.alias("outcome"))


@query(
    "pass_activation",
    """SELECT l_orderkey AS id, l_partkey AS part, CASE WHEN l_returnflag = 'A' THEN l_linestatus <> 'O' ELSE l_linenumber % 2 = 0 OR l_linenumber % 3 > 0 END AS run FROM lineitem""",
)
def pass_activation(spark, d):
    n = F.col("l_linenumber")
    run = W.should_run_questions(F.when(F.col("l_returnflag") == "A", "Q").otherwise("S"), n % 2 == 0, F.nullif(n % 3, F.lit(0)), F.col("l_linestatus") == "O")
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), run.alias("run"))


@query(
    "pass_status",
    """WITH c AS (SELECT l_orderkey AS id, l_partkey AS part, CASE WHEN l_returnflag = 'A' THEN 'Q' ELSE 'S' END AS section, CASE WHEN l_linestatus = 'O' THEN 'Q' ELSE 'S' END AS step, l_linenumber % 3 AS n, l_partkey % 2 = 0 AS err, l_suppkey % 2 = 0 AS rec FROM lineitem)
SELECT id, part, CASE WHEN err AND n > 0 THEN 'RETRYABLE_FAILURE' WHEN err AND NOT rec THEN 'UNRESOLVED' WHEN n > 0 THEN 'SUCCESS' WHEN section = 'S' AND step = 'Q' THEN 'EXPECTED_EMPTY' ELSE 'PARTIAL' END AS status FROM c""",
)
def pass_status(spark, d):
    section, step = F.when(F.col("l_returnflag") == "A", "Q").otherwise("S"), F.when(F.col("l_linestatus") == "O", "Q").otherwise("S")
    out = W.pass_status(section, step, F.col("l_linenumber") % 3, F.col("l_partkey") % 2 == 0, F.col("l_suppkey") % 2 == 0)
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"), out.alias("status"))


@query(
    "watchdog",
    f"""WITH f AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'questions.jsonl' WHEN 1 THEN 'orphans.jsonl' WHEN 2 THEN 'notes_' || p_size || '.jsonl' ELSE p_name END AS name FROM part)
SELECT name, 'watchdog_unregistered_file' AS kind, 'BLOCKER' AS severity FROM f WHERE NOT list_contains({S.q([*P.FLAG_FILES, *P.CORE_FILES])}, name)""",
)
def watchdog(spark, d):
    k = F.col("p_partkey") % 4
    name = F.when(k == 0, "questions.jsonl").when(k == 1, "orphans.jsonl").when(k == 2, F.concat(F.lit("notes_"), s(F.col("p_size")), F.lit(".jsonl"))).otherwise(F.col("p_name"))
    return V.watchdog(table(spark, d, "part").select(name.alias("name")))


_HASH = "substr(sha1(CAST(doc_id AS VARCHAR)), 1, 16)"
_SAMPLED = f"list_reduce(list_prepend(0, list_transform(range(1, 17), lambda i: CAST(strpos('0123456789abcdef', substr({_HASH}, i, 1)) - 1 AS BIGINT))), lambda a, b: (a * 16 + b) % {P.SAMPLE_EVERY}) = 0"


@query("verification", f"SELECT doc_id AS id, CASE WHEN NOT (doc_id % 4 > 0 AND n_chars % 3 > 0 AND lang <> 'de') THEN 'open' WHEN {_SAMPLED} THEN 'sampled_back' ELSE 'closed' END AS outcome FROM documents WHERE lang IS NOT NULL")
def verification(spark, d):
    k = F.substring(F.sha1(s(F.col("doc_id"))), 1, 16)
    out = V.verification(F.col("lang") == "de", F.when(F.col("n_chars") % 3 > 0, "high").otherwise("medium"), F.col("doc_id") % 4 > 0, k)
    return table(spark, d, "documents").where("lang is not null").select(F.col("doc_id").alias("id"), out.alias("outcome"))


@query(
    "scope_mask",
    """WITH c AS (SELECT conv_id, turn, substr('QAS', CAST(turn % 3 + 1 AS INT), 1) AS pass, text, role FROM conversations)
SELECT conv_id, turn, pass, CASE WHEN pass = 'Q' THEN text END AS stem, CASE WHEN pass IN ('A', 'S') THEN role END AS answer, CASE WHEN pass = 'S' THEN text END AS solution FROM c""",
)
def scope_mask(spark, d):
    step = F.substring(F.lit("QAS"), (F.col("turn") % 3 + 1).cast("int"), F.lit(1))
    c = table(spark, d, "conversations").select("conv_id", "turn", step.alias("pass"), F.col("text").alias("stem"), F.col("role").alias("answer"), F.col("text").alias("solution"))
    return M.scope(c).select("conv_id", "turn", "pass", "stem", "answer", "solution")


@query(
    "option_patch",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'A=' || o_orderpriority || ';' ELSE '' END || 'D=' || CASE o_orderkey % 3 WHEN 2 THEN 'kept' ELSE 'fix ' || o_custkey END AS options FROM orders""",
)
def option_patch(spark, d):
    k = F.col("o_orderkey")
    have = F.create_map(F.lit("A"), F.when(k % 5 == 0, F.col("o_orderpriority")), F.lit("D"), F.when(k % 3 == 1, " ").when(k % 3 == 2, "kept"))
    new = W.patch_options(have, F.create_map(F.lit(" d "), F.concat(F.lit("fix "), s(F.col("o_custkey"))), F.lit("B"), F.lit(None).cast("string")))
    text = F.array_join(F.array_sort(F.transform(F.map_entries(new), lambda e: F.concat_ws("=", e["key"], e["value"]))), ";")
    return table(spark, d, "orders").select(k.alias("id"), text.alias("options"))


@query(
    "letter_flip",
    f"""WITH o AS (SELECT doc_id AS id, substr(text, 1, 200) AS sol, unnest(['A', 'B', 'C']) AS k, unnest([lang || ' of the house', substr(text, 20, 40), source]) AS t FROM documents WHERE text IS NOT NULL),
w AS (SELECT id, k, {S.tokens("t")} AS a, {S.tokens("sol")} AS b FROM o), s AS (SELECT id, k, {S.overlap("a", "b")} AS s FROM w),
m AS (SELECT id, arg_max(k, (s, k)) AS k, max(s) AS s FROM s GROUP BY 1)
SELECT id, CASE WHEN s > 0 THEN k END AS best, s > 0 AND k <> 'A' AS flip FROM m""",
)
def letter_flip(spark, d):
    """Which option a text's opening describes, against the keyed letter A."""
    t = table(spark, d, "documents").where("text is not null")
    options = F.create_map(F.lit("A"), F.concat(F.col("lang"), F.lit(" of the house")), F.lit("B"), F.substring("text", 20, 40), F.lit("C"), F.col("source"))
    each = t.select(F.col("doc_id").alias("id"), F.substring("text", 1, 200).alias("sol"), F.explode(options).alias("k", "t"))
    best = each.withColumn("s", X.overlap(X.tokens(F.col("t")), X.tokens(F.col("sol")))).groupBy("id").agg(F.max(F.struct("s", "k")).alias("b"))
    top = F.when(F.col("b.s") > 0, F.col("b.k"))
    return best.select("id", top.alias("best"), F.coalesce(top != "A", F.lit(False)).alias("flip"))


@query(
    "pages_in_details",
    r"""WITH t AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'figure on pages [' || o_custkey || ', ' || (o_custkey + 2) || '] lost' WHEN 1 THEN 'pdf_pages [' || o_orderkey || ']' ELSE o_orderpriority END AS d FROM orders)
SELECT id, array_to_string(list_transform(regexp_extract_all(regexp_extract(d, '\[([0-9, ]*)\]', 1), '\d+'), lambda x: CAST(x AS INT)), ',') AS pages FROM t""",
)
def pages_in_details(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    text = F.when(k % 3 == 0, F.concat(F.lit("figure on pages ["), s(c), F.lit(", "), s(c + 2), F.lit("] lost"))).when(k % 3 == 1, F.concat(F.lit("pdf_pages ["), s(k), F.lit("]"))).otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select(k.alias("id"), F.array_join(K.pages_in(text).cast("array<string>"), ",").alias("pages"))


@query("next_slot", "SELECT 1 + max(CAST(p_size AS INT)) FILTER (p_partkey % 2 = 0) AS next, 1 + max(CAST(p_size AS INT)) FILTER (p_partkey % 2 = 1) AS other, 1 AS fresh FROM part")
def next_slot(spark, d):
    lead = F.when(F.col("p_partkey") % 2 == 0, "S/a_Q_").otherwise("S/b_Q_")
    df = table(spark, d, "part").select(F.concat(lead, F.lpad(s(F.col("p_size")), 2, "0"), F.lit(".webp")).alias("name"))
    return df.agg(W.next_slot(df, F.lit("S/a_Q_")).alias("next"), W.next_slot(df, F.lit("S/b_Q_")).alias("other"), W.next_slot(df, F.lit("S/zz_")).alias("fresh"))


@query(
    "clip_solutions",
    f"""WITH d AS (SELECT o_custkey % 7 AS response, o_orderkey AS q, o_orderkey % 900 + 1 AS n, (o_orderkey + 1) % 900 + 1 AS m, o_orderpriority AS t FROM orders),
there AS (SELECT DISTINCT response, n FROM d)
SELECT response, n AS q_no, q AS row_id, CASE q % 3 WHEN 0 THEN t || ' own' WHEN 1 THEN CASE WHEN m <> n AND EXISTS (SELECT 1 FROM there x WHERE x.response = d.response AND x.n = m) THEN t ELSE t || ' Solution to Question ' || m || ': other' END ELSE t END AS solution FROM d""",
)
def clip_solutions(spark, d):
    k = F.col("o_orderkey")
    o = table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("response"), k.alias("row_id"), (k % 900 + 1).alias("q_no"), ((k + 1) % 900 + 1).alias("m"), F.col("o_orderpriority").alias("t"))
    head = lambda n: F.concat(F.lit("Solution to Question "), s(F.col(n)), F.lit(": "))
    i = F.col("row_id") % 3
    text = F.when(i == 0, F.concat(head("q_no"), F.col("t"), F.lit(" own"))).when(i == 1, F.concat(F.col("t"), F.lit(" "), head("m"), F.lit("other"))).otherwise(F.col("t"))
    return E.clip(o.select("response", "row_id", "q_no", text.alias("solution")), "row_id")


@query(
    "cross_search",
    f"""WITH f AS (SELECT item_id AS frag, substr({S.norm("text")}, 1, 120) AS head FROM benchmark UNION ALL SELECT 100000 + doc_id, substr({S.norm("text")}, 1, 12) FROM documents WHERE doc_id IN (SELECT item_id FROM benchmark)),
r AS (SELECT doc_id AS q_no, {S.norm("text")} AS body FROM documents)
SELECT frag, min(q_no) AS q_no FROM f JOIN r ON strpos(body, head) > 0 WHERE head <> '' GROUP BY 1""",
)
def cross_search(spark, d):
    b, t = table(spark, d, "benchmark"), table(spark, d, "documents")
    short = t.join(b.select(F.col("item_id").alias("doc_id")), "doc_id", "left_semi").select((100000 + F.col("doc_id")).alias("frag"), "text", F.lit(12).alias("size"))
    fragments = b.select(F.col("item_id").alias("frag"), "text", F.lit(120).alias("size")).unionByName(short)
    return E.cross_search(fragments, t.select(F.col("doc_id").alias("q_no"), F.col("text").alias("solution")), F.col("size"))


_HEADED = f"""o AS (SELECT o_orderkey AS row_id, o_custkey % 5 AS chapter, o_orderkey % 700 + 1 AS q_no, (o_orderkey * 7 + 3) % 900 + 1 AS m, o_orderpriority AS t, o_orderkey % 4 AS i FROM orders),
sol AS (SELECT *, CASE i WHEN 0 THEN t WHEN 1 THEN t || ' Solution to Question ' || m || ': other' WHEN 2 THEN ' ' ELSE 'Solution to Question ' || q_no || ': own' END AS solution FROM o)"""


@query(
    "heal_dump_tail",
    f"""WITH {_HEADED}, own AS (SELECT DISTINCT chapter, q_no FROM sol WHERE i <> 2)
SELECT row_id, chapter, q_no, CASE WHEN i = 1 AND m <> q_no AND EXISTS (SELECT 1 FROM own WHERE own.chapter = sol.chapter AND own.q_no = m) THEN t ELSE solution END AS healed FROM sol""",
)
def heal_dump_tail(spark, d):
    k, i = F.col("o_orderkey"), F.col("o_orderkey") % 4
    head = lambda n, rest: F.concat(F.lit("Solution to Question "), s(n), F.lit(rest))
    q, m, t = k % 700 + 1, (k * 7 + 3) % 900 + 1, F.col("o_orderpriority")
    text = F.when(i == 0, t).when(i == 1, F.concat(t, F.lit(" "), head(m, ": other"))).when(i == 2, " ").otherwise(head(q, ": own"))
    return H.trim_dumps(table(spark, d, "orders").select(k.alias("row_id"), (F.col("o_custkey") % 5).alias("chapter"), q.alias("q_no"), text.alias("solution"))).drop("solution")


@query(
    "head_donation",
    f"""WITH {_LINES}, r AS (SELECT *, last_value(CASE WHEN flag = 'A' THEN id END IGNORE NULLS) OVER (PARTITION BY chapter ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS dest FROM li),
g AS (SELECT chapter, dest, min(id) AS giver FROM r WHERE flag = 'R' AND dest IS NOT NULL GROUP BY ALL)
SELECT r.chapter, r.id AS q_no, CASE WHEN flag = 'N' THEN 'full ' || part WHEN flag = 'R' AND g2.giver IS NOT NULL THEN 'Solution to Question ' || r.id || ': own' WHEN flag = 'R' THEN 'Text of ' || part || '. Solution to Question ' || r.id || ': own'
  WHEN g.giver IS NOT NULL THEN 'Text of ' || (SELECT part FROM li x WHERE x.chapter = r.chapter AND x.id = g.giver) || '.' END AS healed
FROM r LEFT JOIN g ON flag = 'A' AND g.chapter = r.chapter AND g.dest = r.id LEFT JOIN g g2 ON g2.chapter = r.chapter AND g2.giver = r.id""",
)
def head_donation(spark, d):
    own = F.concat(F.lit("Text of "), s(F.col("part")), F.lit(". Solution to Question "), s(F.col("q_no")), F.lit(": own"))
    text = F.when(F.col("flag") == "N", F.concat(F.lit("full "), s(F.col("part")))).when(F.col("flag") == "R", own)
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("q_no")).agg(F.min("l_returnflag").alias("flag"), F.max("l_partkey").alias("part"))
    return H.donate_heads(li.select("chapter", "q_no", text.alias("solution"))).drop("solution")


@query(
    "heal_tables",
    f"""WITH t AS (SELECT o_orderkey AS id, ['Answer', 'table', 'table', 'answer key', 'x'] AS ty, ['Question | Correct Option' || {NL} || '1 | A', '| ' || o_orderpriority || ' |', '|  ' || lower(o_orderpriority) || CASE WHEN o_custkey % 2 = 0 THEN ' |' ELSE ' ! |' END,
  CASE WHEN o_custkey % 3 = 0 THEN 'other' ELSE 'the Correct Option' END, '|' || o_orderpriority || '|'] AS md FROM orders),
k AS (SELECT *, list_transform(md, lambda x: regexp_replace(lower(x), '\\s+', '', 'g')) AS ks FROM t),
f AS (SELECT id, list_transform(list_filter(range(1, 6), lambda i: NOT (contains(lower(ty[i]), 'answer') AND contains(md[i], 'Correct Option')) AND NOT (ks[i] <> '' AND list_contains(ks[1:i - 1], ks[i]))), lambda i: md[i]) AS kept FROM k)
SELECT id, array_to_string(kept, ';') AS kept, CAST(len(kept) AS INT) AS n FROM f""",
)
def heal_tables(spark, d):
    p, c = F.col("o_orderpriority"), F.col("o_custkey")
    t = lambda kind, md: F.struct(F.lit(kind).alias("type"), md.alias("markdown"))
    third = F.concat(F.lit("|  "), F.lower(p), F.when(c % 2 == 0, " |").otherwise(" ! |"))
    tables = F.array(t("Answer", F.lit("Question | Correct Option\n1 | A")), t("table", F.concat(F.lit("| "), p, F.lit(" |"))), t("table", third),
                     t("answer key", F.when(c % 3 == 0, "other").otherwise("the Correct Option")), t("x", F.concat(F.lit("|"), p, F.lit("|"))))
    once = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), H.drop_tables(tables).alias("h"))
    return once.withColumn("h", H.drop_tables(F.col("h"))).select("id", F.array_join(F.transform("h", lambda x: x["markdown"]), ";").alias("kept"), F.size("h").alias("n"))


_GRID = f"""grid AS (SELECT p_brand AS chapter, p_partkey AS id, list_concat(list_transform(range(1, p_size % 5 + 2), lambda i: 'r' || i), CASE WHEN p_partkey % 7 = 0 THEN ['z'] ELSE [] END) AS r, 'H' || p_partkey % 2 AS h FROM part),
md AS (SELECT *, '| ' || h || ' |' || {NL} || '|---|' || {NL} || array_to_string(list_transform(r, lambda x: '| ' || x || ' |'), {NL}) AS markdown FROM grid)"""
_BETTER = f"""{_GRID}, best AS (SELECT a.chapter, a.id, arg_max(b.markdown, (len(b.r), -b.id)) AS better FROM md a JOIN md b ON a.chapter = b.chapter AND a.h = b.h AND a.id <> b.id
  WHERE len(b.r) > len(a.r) AND len(list_filter(a.r, lambda x: NOT list_contains(b.r, x))) = 0 GROUP BY ALL)"""


def _grid(spark, d):
    k = F.col("p_partkey")
    rows = F.concat(F.transform(F.sequence(F.lit(1), F.col("p_size") % 5 + 1), lambda i: F.concat(F.lit("| r"), s(i), F.lit(" |"))), F.when(k % 7 == 0, F.array(F.lit("| z |"))).otherwise(F.array().cast("array<string>")))
    md = F.concat(F.lit("| H"), s(k % 2), F.lit(" |\n|---|\n"), F.array_join(rows, "\n"))
    return table(spark, d, "part").select(F.col("p_brand").alias("chapter"), k.alias("id"), F.lit(0).alias("pos"), md.alias("markdown"))


@query("heal_tables_from_siblings", f"WITH {_BETTER} SELECT id, coalesce(better, markdown) AS healed FROM md LEFT JOIN best USING (chapter, id)")
def heal_tables_from_siblings(spark, d):
    return H.complete_tables(_grid(spark, d)).select("id", "healed")


@query("heal_archive", f"WITH {_BETTER} SELECT id, markdown AS before, better AS after FROM md JOIN best USING (chapter, id) WHERE markdown <> better")
def heal_archive(spark, d):
    df = _grid(spark, d)
    return H.archive(df, H.complete_tables(df).select("id", F.col("healed").alias("markdown")), ["id"], "markdown")


@query(
    "truncated_tables",
    f"""WITH {_GRID}, n AS (SELECT chapter, id, h, len(r) AS rows, max(len(r)) OVER (PARTITION BY chapter, h) AS largest FROM md)
SELECT chapter, id, rows, largest FROM n WHERE rows <= largest - {P.TABLE_ROW_DEFICIT}""",
)
def truncated_tables(spark, d):
    return H.short_siblings(_grid(spark, d))


@query(
    "table_dedupe",
    f"""WITH t AS (SELECT o_orderkey AS id, o_orderkey % 4 + 1 AS a, o_custkey % 4 + 1 AS b FROM orders)
SELECT id, 2 AS n, '| H |' || {NL} || '|---|' || {NL} || array_to_string(list_transform(range(1, CAST(greatest(a, b) AS BIGINT) + 1), lambda i: '| ' || i || ' |'), {NL}) AS first FROM t""",
)
def table_dedupe(spark, d):
    md = lambda n: F.concat(F.lit("| H |\n|---|\n"), F.array_join(F.transform(F.sequence(F.lit(1).cast("long"), n), lambda i: F.concat(F.lit("| "), s(i), F.lit(" |"))), "\n"))
    other = F.concat(F.lit("| G |\n|---|\n| "), s(F.col("o_orderkey")), F.lit(" |"))
    tables = F.array(md(F.col("o_orderkey") % 4 + 1), md(F.col("o_custkey") % 4 + 1), other)
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), MD.dedupe(tables).alias("t")).select("id", F.size("t").alias("n"), F.get("t", F.lit(0)).alias("first"))


@query(
    "inline_tables",
    f"""WITH t AS (SELECT o_orderkey AS id, o_orderkey % 5 AS n, o_orderpriority AS p FROM orders)
SELECT id, 'Before ' || p || {NL} || CASE WHEN n >= 3 THEN '' ELSE array_to_string(list_transform(range(n), lambda i: '| ' || i || ' |' || {NL}), '') END || 'after' AS prose, CAST(n >= 3 AS INT) AS tables FROM t""",
)
def inline_tables(spark, d):
    n = (F.col("o_orderkey") % 5).cast("int")
    rows = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit("| "), s(i), F.lit(" |\n")))
    out = MD.split_inline(F.concat(F.lit("Before "), F.col("o_orderpriority"), F.lit("\n"), F.array_join(rows, ""), F.lit("after")))
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), out.alias("o")).select("id", F.col("o.prose").alias("prose"), F.size("o.tables").alias("tables"))


_NOVEL = f"substr(text, 1, 40) || {NL} || {NL} || 'Extra ' || doc_id || {NL} || ' ' || {NL} || lower(substr(text, 5, 30))"


@query(
    "paragraph_novelty",
    rf"""WITH t AS (SELECT doc_id AS id, coalesce({_NOVEL}, '') AS f, {S.norm("text")} AS have FROM documents)
SELECT id, array_to_string(list_filter(regexp_split_to_array(f, '\n\s*\n'), lambda p: {S.strip("p")} <> '' AND strpos(have, {S.norm("p")}) = 0), '|') AS missing FROM t""",
)
def paragraph_novelty(spark, d):
    f = F.concat(F.substring("text", 1, 40), F.lit("\n\nExtra "), s(F.col("doc_id")), F.lit("\n \n"), F.lower(F.substring("text", 5, 30)))
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.array_join(H.missing_paragraphs(f, F.col("text")), "|").alias("missing"))


@query(
    "orphan_ladder",
    """WITH o AS (SELECT o_orderkey AS orphan, o_custkey AS chapter, ['solution', 'options', 'stem'][o_orderkey % 3 + 1] AS field, 'Value ' || o_orderkey % 4 AS value,
  [CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 4 + 1 END, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7 + 1 END, CASE WHEN o_orderkey % 3 = 1 THEN 2 END, o_orderkey % 3 + 1] AS c FROM orders),
r AS (SELECT c_custkey AS chapter, q, f AS field, CASE (c_custkey + q) % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'the VALUE  ' || c_custkey % 4 || ' here' ELSE NULL END AS have, (c_custkey + q) % 3 AS m FROM customer, unnest([1, 2, 3]) u(q), unnest(['solution', 'options']) v(f)),
j AS (SELECT orphan, rk, q, CASE WHEN m <> 1 THEN 'filled' WHEN strpos('the value ' || o.chapter % 4 || ' here', lower(value)) > 0 THEN 'consumed' END AS outcome
  FROM (SELECT *, unnest(range(1, 5)) AS rk FROM o) o JOIN r ON r.chapter = o.chapter AND r.field = o.field AND r.q = o.c[rk] WHERE rk < 4 OR o.field = 'solution'),
b AS (SELECT orphan, arg_min(q, rk) AS owner, min(rk) AS rk, arg_min(outcome, rk) AS outcome FROM j WHERE outcome IS NOT NULL GROUP BY 1)
SELECT o.orphan, owner, ['self_labelled', 'carry', 'last_question', 'page_position'][rk] AS rule, coalesce(outcome, 'blocked') AS outcome FROM o LEFT JOIN b USING (orphan)""",
)
def orphan_ladder(spark, d):
    k = F.col("o_orderkey")
    field = F.get(F.array(F.lit("solution"), F.lit("options"), F.lit("stem")), (k % 3).cast("int"))
    o = table(spark, d, "orders").select(k.alias("orphan"), F.col("o_custkey").alias("chapter"), field.alias("field"), F.concat(F.lit("Value "), s(k % 4)).alias("value"), F.when(k % 5 == 0, k % 4 + 1).alias("label"),
                                         F.when(k % 2 == 0, k % 7 + 1).alias("carry_no"), F.when(k % 3 == 1, F.lit(2).cast("long")).alias("last_no"), (k % 3 + 1).alias("page_no"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("chapter"), F.explode(F.array(*[F.lit(n).cast("long") for n in (1, 2, 3)])).alias("q_no"))
    m = (F.col("chapter") + F.col("q_no")) % 3
    have = F.when(m == 0, " ").when(m == 1, F.concat(F.lit("the VALUE  "), s(F.col("chapter") % 4), F.lit(" here")))
    c = c.select("chapter", "q_no", F.explode(F.array(F.lit("solution"), F.lit("options"))).alias("field"), have.alias("value"))
    return H.recover_orphans(o, c)


@query(
    "phantom_drop",
    f"""WITH t AS (SELECT doc_id AS q_no, source AS chapter, substr(text, 1, 300) AS a, CASE WHEN doc_id % 3 = 0 THEN substr(text, 20, 250) ELSE lang || ' is not it' END AS b FROM documents WHERE doc_id % 2 = 0 AND doc_id % 5 > 0),
w AS (SELECT q_no, chapter, {S.tokens("a")} AS x, {S.tokens("b")} AS y FROM t WHERE NOT {_BL("a")}), z AS (SELECT chapter, q_no, {S.overlap("x", "y")} AS score FROM w) SELECT * FROM z WHERE score >= 0.5""",
)
def phantom_drop(spark, d):
    t, k = table(spark, d, "documents"), F.col("doc_id")
    rows = t.select(F.col("source").alias("chapter"), k.alias("q_no"), F.when(k % 2 > 0, "stem").alias("stem"), F.substring("text", 1, 300).alias("solution"), (k % 5 == 0).alias("question_pass"))
    prior = t.select(k.alias("q_no"), F.when(k % 3 == 0, F.substring("text", 20, 250)).otherwise(F.concat("lang", F.lit(" is not it"))).alias("solution"))
    return H.drop_phantoms(rows, prior)


_ITEMS = """it AS (SELECT l_orderkey AS chapter, nullif(l_linenumber, 7) AS q_no, l_partkey AS seq, substr('QAS', CAST(l_partkey % 3 + 1 AS INT), 1) AS pass, CASE WHEN l_partkey % 5 > 0 THEN 'Which one is ' || l_partkey || '?' END AS stem,
  CASE WHEN l_partkey % 2 = 0 THEN chr(CAST(65 + l_partkey % 4 AS INT)) END AS answer, 'Because N' || l_partkey || '.' AS solution FROM lineitem)"""


def _items(spark, d):
    p = F.col("l_partkey")
    step = F.substring(F.lit("QAS"), (p % 3 + 1).cast("int"), F.lit(1))
    stem = F.when(p % 5 > 0, F.concat(F.lit("Which one is "), s(p), F.lit("?")))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.nullif(F.col("l_linenumber"), F.lit(7)).alias("q_no"), p.alias("seq"), step.alias("pass"), stem.alias("stem"),
                                              F.when(p % 2 == 0, F.char(65 + p % 4)).alias("answer"), F.concat(F.lit("Because N"), s(p), F.lit(".")).alias("solution"))


_KNOWN = "kn AS (SELECT o_orderkey AS chapter, unnest([1, 2, 3, 4, 5]) AS q_no FROM orders WHERE o_orderkey % 10 > 0)"


def _known(spark, d):
    return table(spark, d, "orders").where("o_orderkey % 10 > 0").select(F.col("o_orderkey").alias("chapter"), F.explode(F.sequence(F.lit(1), F.lit(5))).alias("q_no"))


@query(
    "merge_records",
    f"""WITH {_ITEMS}, {_KNOWN}, k AS (SELECT * FROM it WHERE EXISTS (SELECT 1 FROM kn WHERE kn.chapter = it.chapter AND kn.q_no = it.q_no)),
z AS (SELECT chapter, q_no, seq, CASE WHEN pass = 'Q' THEN stem END AS stem, CASE WHEN pass <> 'Q' THEN answer END AS answer, CASE WHEN pass = 'S' THEN solution END AS solution FROM k)
SELECT chapter, q_no, arg_min(stem, seq) FILTER (stem IS NOT NULL) AS stem, arg_min(answer, seq) FILTER (answer IS NOT NULL) AS answer, arg_max(solution, seq) FILTER (solution IS NOT NULL) AS solution,
  CAST(count(DISTINCT stem) > 1 AS INT) + CAST(count(DISTINCT answer) > 1 AS INT) AS conflicts FROM z GROUP BY ALL""",
)
def merge_records(spark, d):
    return M.merge(_items(spark, d), _known(spark, d))[0]


@query(
    "merge_skipped",
    f"""WITH {_ITEMS}, {_KNOWN} SELECT chapter, q_no, seq, CASE WHEN q_no IS NULL THEN 'no number' ELSE 'foreign number' END AS reason FROM it
WHERE q_no IS NULL OR NOT EXISTS (SELECT 1 FROM kn WHERE kn.chapter = it.chapter AND kn.q_no = it.q_no)""",
)
def merge_skipped(spark, d):
    return M.merge(_items(spark, d), _known(spark, d))[1].select("chapter", "q_no", "seq", "reason")


@query(
    "option_owner",
    f"""WITH {_LINES}, f AS (SELECT chapter AS page, id AS fig, part % 50 * 10.0 AS x, id * 100.0 AS y FROM li WHERE flag <> 'A'),
b AS (SELECT chapter AS page, chr(CAST(65 + id % 4 AS INT)) AS letter, part % 37 * 10.0 AS x, id // 2 * 200.0 AS y FROM li WHERE flag = 'A'),
j AS (SELECT f.page, fig, letter, abs(b.x - f.x) AS d, b.y, min(b.y) OVER (PARTITION BY f.page, fig) AS r FROM f JOIN b ON f.page = b.page AND b.y > f.y),
g AS (SELECT page, fig, list_sort(list({{'d': d, 'letter': letter}})) AS c FROM j WHERE abs(y - r) <= 1 GROUP BY ALL)
SELECT f.page, f.fig, CASE WHEN len(c) = 1 OR c[2].d - c[1].d >= 20 THEN c[1].letter END AS letter FROM f LEFT JOIN g ON f.page = g.page AND f.fig = g.fig""",
)
def option_owner(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("fig")).agg(F.min("l_returnflag").alias("flag"), F.max("l_partkey").alias("part"))
    num = lambda c: c.cast("double")
    figures = li.where("flag <> 'A'").select("page", "fig", num(F.col("part") % 50 * 10).alias("x"), num(F.col("fig") * 100).alias("y"))
    labels = li.where("flag = 'A'").select("page", F.char(65 + F.col("fig") % 4).alias("letter"), num(F.col("part") % 37 * 10).alias("x"), num(F.floor(F.col("fig") / 2) * 200).alias("y"))
    return M.option_owner(figures, labels)


_SEVEN = S.q(list(P.SPLIT_FILES))


@query(
    "rubric",
    f"""WITH c AS (SELECT o_custkey AS chapter, o_orderkey AS q, o_orderstatus AS st FROM orders),
r AS (SELECT chapter, count(*) AS n, count(*) FILTER (q % 4 = 0) AS g1, count(*) FILTER (q % 4 > 0) + CAST(chapter % 13 = 0 AS INT) AS g2, list(q) AS qs FROM c GROUP BY 1),
lone AS (SELECT DISTINCT chapter FROM c WHERE q % 97 = 0),
f AS (SELECT chapter, list_filter([CASE WHEN chapter % 17 = 0 THEN 'files_exist' END, CASE WHEN chapter % 11 = 0 THEN 'grade_values' END, CASE WHEN g1 + g2 <> n THEN 'grade_sum' END, CASE WHEN chapter % 19 = 0 THEN 'phase2_pending' END,
  CASE WHEN chapter % 23 = 0 THEN 'extraction_status' END, CASE WHEN chapter IN (SELECT chapter FROM lone) THEN 'qid_set_consistency' END, CASE WHEN chapter % 29 = 0 THEN 'unresolved_qids' END], lambda x: x IS NOT NULL) AS f FROM r)
SELECT chapter, array_to_string(f, ',') AS failed, len(f) = 0 AS passed FROM f""",
)
def rubric(spark, d):
    """The seven checks over a roll-up of orders, spoilt in some chapters."""
    c, k = F.col("chapter"), F.col("q")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("chapter"), F.col("o_orderkey").alias("q"))
    r = o.groupBy("chapter").agg(F.count("*").alias("question_records"), F.count_if(k % 4 == 0).alias("g1"), F.count_if(k % 4 > 0).alias("g2"))
    files = F.array(*map(F.lit, P.SPLIT_FILES))
    none = F.array().cast("array<string>")
    r = r.select(
        "chapter", "question_records",
        F.when(c % 17 == 0, F.slice(files, 1, 6)).otherwise(files).alias("files"),
        F.create_map(F.lit("RESOLVED"), F.col("g1"), F.when(c % 11 == 0, "GUESSED").otherwise("PROVISIONAL"), F.col("g2") + F.when(c % 13 == 0, 1).otherwise(0)).alias("grade_counts"),
        F.when(c % 19 == 0, F.array(F.lit("ocr_stem"))).otherwise(none).alias("pending"),
        F.when(c % 23 == 0, F.array(F.lit("COMPLETE"), F.lit("HALF"))).otherwise(F.array(F.lit("COMPLETE"), F.lit("INCOMPLETE"))).alias("statuses"),
        F.when(c % 29 == 0, F.array(F.lit(3), F.lit(1))).otherwise(F.array(F.lit(1), F.lit(3))).alias("unresolved"),
    )
    ids = o.select("chapter", k.alias("q_id"))
    most = ids.where("q_id % 97 > 0")
    return R.rubric(r, ids, most, most)
