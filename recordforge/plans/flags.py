"""Queries of flags as rows, provenance, anchors, decisions and context, bound to the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordforge.operators import flags as G
from recordforge.operators import healing as H
from recordforge.operators import records as R

from . import sql as S
from .bound import _GRID, _LINES, NL, _grid, s
from .evidence import split_text
from .records import _BL, _RATES, _rates, numbered, table
from .registry import query
from .review import _DECIDED, _decided

_N = "n AS (SELECT CAST(l_orderkey AS VARCHAR) AS chapter, CAST(l_linenumber AS BIGINT) AS q_no, count(*) AS c FROM lineitem GROUP BY ALL)"


@query(
    "numbering_flags",
    f"""WITH {_N}, x AS (SELECT *, lead(q_no) OVER (PARTITION BY chapter ORDER BY q_no) AS nxt FROM n)
SELECT chapter, 'numbering_gap' AS kind, 'HIGH' AS severity, q_no + 1 AS q_no, 'absent: ' || (q_no + 1) || '..' || (nxt - 1) AS detail FROM x WHERE nxt > q_no + 1
UNION ALL SELECT chapter, 'numbering_start', 'LOW', min(q_no), 'series starts at ' || min(q_no) FROM n GROUP BY 1 HAVING min(q_no) <> 1""",
)
def numbering_flags(spark, d):
    return G.numbering(numbered(spark, d))


@query("duplicate_id_flags", f"WITH {_N} SELECT chapter, 'duplicate_id' AS kind, 'HIGH' AS severity, q_no, c || ' rows' AS detail FROM n WHERE c > 1")
def duplicate_id_flags(spark, d):
    return G.duplicate_ids(numbered(spark, d))


@query(
    "density_flags",
    f"""WITH {_RATES}, m AS (SELECT list_sort(list(rate))[count(*) // 2 + 1] AS median FROM r)
SELECT chapter, 'suspect_density' AS kind, 'HIGH' AS severity, CAST(NULL AS BIGINT) AS q_no, 'missing solutions stand out' AS detail FROM r, m WHERE rate >= greatest(0.5, median * 3.0)""",
)
def density_flags(spark, d):
    return G.density(_rates(spark, d))


_TWO_TEXTS = """t AS (SELECT source AS chapter, doc_id AS q_no, 'Give ' || n_chars % 50 || ' mg daily for ' || doc_id % 7 || ' weeks, at most ' || doc_id % 3 || ' Gy in all.' AS solution,
  CASE WHEN doc_id % 4 = 0 THEN 'no numbers here' ELSE n_chars % 25 || ' mg; ' || doc_id % 7 || ' weeks; ' || doc_id % 2 || ' Gy' END AS page FROM documents)"""


@query(
    "drift_flags",
    f"""WITH {_TWO_TEXTS}, n AS (SELECT chapter, q_no, list_sort(list_distinct(list_filter([split_part(solution, ' ', 2) || 'mg', split_part(solution, ' ', 6) || 'weeks', split_part(solution, ' ', 10) || 'Gy'],
  lambda x: NOT list_contains([split_part(page, ' ', 1) || 'mg', split_part(page, ' ', 3) || 'weeks', split_part(page, ' ', 5) || 'Gy'], x)))) AS a, page FROM t)
SELECT chapter, 'numeric_drift_suspect' AS kind, 'HIGH' AS severity, q_no, array_to_string(a, ',') AS detail FROM n WHERE page <> 'no numbers here' AND len(a) > 0""",
)
def drift_flags(spark, d):
    k, n = F.col("doc_id"), F.col("n_chars")
    text = F.concat(F.lit("Give "), s(n % 50), F.lit(" mg daily for "), s(k % 7), F.lit(" weeks, at most "), s(k % 3), F.lit(" Gy in all."))
    page = F.when(k % 4 == 0, "no numbers here").otherwise(F.concat(s(n % 25), F.lit(" mg; "), s(k % 7), F.lit(" weeks; "), s(k % 2), F.lit(" Gy")))
    return G.drift(table(spark, d, "documents").select(F.col("source").alias("chapter"), k.alias("q_no"), text.alias("solution"), page.alias("page")))


@query(
    "image_flags",
    """WITH r AS (SELECT CAST(l_orderkey AS VARCHAR) AS chapter, CAST(l_linenumber AS BIGINT) AS q_no, CASE l_returnflag WHEN 'A' THEN 'question' ELSE 'solution' END AS side, 'S/' || l_partkey || '.webp' AS file FROM lineitem),
d AS (SELECT 'S/' || p_partkey || '.webp' AS file, p_size * 100 AS bytes FROM part WHERE p_partkey % 9 > 0)
SELECT chapter, CASE WHEN bytes IS NULL THEN 'image_ref_missing' ELSE 'suspicious_tiny_image' END AS kind, 'HIGH' AS severity, q_no, side || ' ' || r.file AS detail FROM r LEFT JOIN d USING (file) WHERE bytes IS NULL OR bytes < 1500""",
)
def image_flags(spark, d):
    file = lambda c: F.concat(F.lit("S/"), s(F.col(c)), F.lit(".webp")).alias("file")
    side = F.when(F.col("l_returnflag") == "A", "question").otherwise("solution")
    refs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("q_no"), side.alias("side"), file("l_partkey"))
    return G.images(refs, table(spark, d, "part").where("p_partkey % 9 > 0").select(file("p_partkey"), (F.col("p_size") * 100).alias("bytes")))


@query(
    "truncated_table_flags",
    f"""WITH {_GRID}, n AS (SELECT chapter, id, 'h' || id % 2 AS h, len(r) AS n, max(len(r)) OVER (PARTITION BY chapter, h) AS top FROM md)
SELECT chapter, 'suspect_truncated_table' AS kind, 'HIGH' AS severity, id AS q_no, n || ' of ' || top || ' rows: ' || h AS detail FROM n WHERE n <= top - 3 AND id % 3 = 0""",
)
def truncated_table_flags(spark, d):
    t = _grid(spark, d).withColumnRenamed("id", "q_no")
    return G.truncated_tables(t, t.select("chapter", "q_no", F.when(F.col("q_no") % 3 == 0, "as follows: \n").otherwise("it ends.").alias("solution")))


@query(
    "sidecar_flags",
    """WITH p AS (SELECT CASE WHEN p_partkey % 7 > 0 THEN p_brand END AS chapter, p_partkey, p_size, p_name FROM part)
SELECT chapter, 'orphan_unresolved' AS kind, 'HIGH' AS severity, CAST(NULL AS BIGINT) AS q_no, 'fragment without a number' AS detail FROM p WHERE p_partkey % 4 = 0 AND chapter IS NOT NULL
UNION ALL SELECT chapter, 'image_unclaimed', 'HIGH', NULL, 'page ' || coalesce(CAST(nullif(p_size, 3) AS VARCHAR), '?') || ': ' || p_name FROM p WHERE p_partkey % 4 = 1 AND chapter IS NOT NULL
UNION ALL SELECT chapter, 'image_unresolved', 'HIGH', NULL, 'page ' || coalesce(CAST(nullif(p_size, 3) AS VARCHAR), '?') || ': ' || p_name FROM p WHERE p_partkey % 4 = 2 AND chapter IS NOT NULL AND p_size % 2 = 1
UNION ALL SELECT chapter, 'image_owner_gate_miss', 'HIGH', p_partkey, p_name FROM p WHERE p_partkey % 4 = 3 AND chapter IS NOT NULL AND p_size > 20""",
)
def sidecar_flags(spark, d):
    p = table(spark, d, "part").withColumn("chapter", F.when(F.col("p_partkey") % 7 > 0, F.col("p_brand")))
    of = lambda k: p.where(f"p_partkey % 4 = {k}")
    image = lambda k: of(k).select("chapter", F.nullif(F.col("p_size"), F.lit(3)).alias("page"), F.col("p_name").alias("file"), F.when(F.col("p_size") != 5, F.col("p_size") % 2 == 0).alias("junk"))
    gate = of(3).select("chapter", F.when(F.col("p_size") > 20, "figure_page_mismatch").otherwise("bad_options").alias("kind"), F.col("p_partkey").alias("q_no"), F.col("p_name").alias("detail"))
    return G.sidecar(of(0), image(1), image(2), gate)


@query("duplicate_text_flags")
def duplicate_text_flags(spark, d):
    """Near-duplicate first lines and which of the two is the suspect; tested against all pairs."""
    r = split_text(table(spark, d, "documents")).select(F.col("source").alias("chapter"), F.col("doc_id").alias("id"), F.col("text").alias("stem"), F.col("solution").alias("payload"))
    return G.duplicate_texts(r)


@query(
    "neighbor_runs",
    """WITH t AS (SELECT l_orderkey AS chapter, count(DISTINCT l_linenumber) AS size, min(l_linenumber) AS first, max(l_linenumber) AS last FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
k AS (SELECT l_orderkey AS chapter, max(l_linenumber) AS m FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1)
SELECT chapter, size, first, last, coalesce(first - m <= 3, false) AS near_chapter_max FROM t LEFT JOIN k USING (chapter)""",
)
def neighbor_runs(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("q_no"), "l_returnflag")
    return G.neighbor_runs(li.where("l_returnflag = 'A'"), li.where("l_returnflag = 'N'"))


@query("ordered_records", f"WITH {_LINES} SELECT chapter, id AS q_no, flag, part, row_number() OVER (ORDER BY chapter, id) AS place FROM li")
def ordered_records(spark, d):
    """Records in the order of chapter and number, with their place; places are offsets of ranges, not one task's work."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("chapter"), F.col("l_linenumber").alias("q_no")).agg(F.min("l_returnflag").alias("flag"), F.max("l_partkey").alias("part"))
    return R.placed(li, "chapter", "q_no")


_PROV = f"""p AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS stem, CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'x' END AS options, o_orderstatus AS answer,
  CASE WHEN o_orderkey % 5 > 0 THEN 'y' END AS solution, o_custkey FROM orders),
q AS (SELECT *, [CASE WHEN NOT {_BL("stem")} THEN 'Q_PASS' END, CASE WHEN NOT {_BL("options")} THEN CASE WHEN o_custkey % 2 = 0 THEN 'Q_RETRY' END END, 'A_PASS', CASE WHEN NOT {_BL("solution")} THEN 'S_PASS' END] AS l FROM p)"""


def _prov(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    prov = F.create_map(F.lit("stem"), F.lit("Q_PASS"), F.lit("options"), F.when(c % 2 == 0, "Q_RETRY").otherwise(""), F.lit("answer"), F.lit("A_PASS"), F.lit("solution"), F.lit("S_PASS"))
    o = table(spark, d, "orders").select(k.alias("id"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("stem"), F.when(k % 3 == 0, " ").otherwise("x").alias("options"), F.col("o_orderstatus").alias("answer"),
                                         F.when(k % 5 > 0, "y").alias("solution"), c.alias("o_custkey"), prov.alias("prov"))
    return G.provenance(o)


@query("field_provenance", f"WITH {_PROV} SELECT id, l[1] AS stem, l[2] AS options, l[3] AS answer, l[4] AS solution, array_to_string(list_sort(list_distinct(list_filter(l, lambda x: x IS NOT NULL))), ',') AS passes FROM q")
def field_provenance(spark, d):
    return _prov(spark, d).select("id", *[F.try_element_at("field_provenance", F.lit(f)).alias(f) for f in G.PROVENANCE], F.array_join("passes", ",").alias("passes"))


@query(
    "anchor_vectors",
    f"""WITH {_PROV} SELECT id, '{{"model_q_no":' || CASE WHEN id % 4 = 0 THEN id % 100 ELSE o_custkey % 100 END || ',"provenance_notes":["' || array_to_string(list_sort(list_distinct(list_filter(l, lambda x: x IS NOT NULL))), '","') || '"]'
  || CASE WHEN o_custkey % 3 = 0 THEN ',"anchors":{{"printed_stem":"' || o_custkey || '"}}' ELSE '' END || CASE WHEN id % 6 > 0 THEN ',"section_position":{{"kind":"page_set","pages":[' || CASE WHEN id % 6 = o_custkey % 5 THEN CAST(id % 6 AS VARCHAR)
  ELSE least(id % 6, o_custkey % 5) || ',' || greatest(id % 6, o_custkey % 5) END || ']}}' ELSE '' END || '}}' AS anchors_json FROM q""",
)
def anchor_vectors(spark, d):
    k, c = F.col("id"), F.col("o_custkey")
    r = _prov(spark, d).withColumn("model_q_no", F.when(k % 4 > 0, c % 100)).withColumn("q_no", k % 100)
    r = r.withColumn("pages", F.when(k % 6 > 0, F.array(k % 6, c % 5, k % 6)).otherwise(F.array().cast("array<bigint>")))
    r = r.withColumn("anchors", F.create_map(F.lit("printed_stem"), F.when(c % 3 == 0, s(c)), F.lit("key_row"), F.lit(" ")))
    return G.anchor_vector(r).select("id", "anchors_json")


@query("orphan_keys", """SELECT o_orderkey AS id, substr(sha1(o_custkey || '|{"answer":"' || o_orderstatus || '","stem":"' || o_orderpriority || '"}|' || o_orderkey % 9 || ',' || o_orderkey % 4), 1, 16) AS k FROM orders""")
def orphan_keys(spark, d):
    k = F.col("o_orderkey")
    item = F.struct(F.col("o_orderstatus").alias("answer"), F.col("o_orderpriority").alias("stem"))
    return table(spark, d, "orders").select(k.alias("id"), G.orphan_key(s(F.col("o_custkey")), item, F.array(k % 9, k % 4)).alias("k"))


@query("bulk_decisions", f"WITH {_DECIDED} SELECT DISTINCT flag_key, 'ignored' AS action, q_id FROM ov WHERE state <> 'closed' AND kind = 'answer_key_disagrees' AND severity = 'BLOCKER'")
def bulk_decisions(spark, d):
    return G.decide(_decided(spark, d), "ignored", kind="answer_key_disagrees", severity="BLOCKER").select("flag_key", "action", "q_id")


@query(
    "flag_context",
    f"""WITH {_DECIDED}, im AS (SELECT CAST(l_partkey AS VARCHAR) AS q_id, list_sort(list_distinct(list(l_suppkey))) AS f FROM lineitem GROUP BY 1), fr AS (SELECT CAST(conv_id AS VARCHAR) AS q_id, list_sort(list_distinct(list(turn))) AS f FROM conversations GROUP BY 1)
SELECT flag_key, ov.q_id, array_to_string([page_id], ',') AS pages, coalesce(array_to_string(im.f, ','), '') AS images, coalesce(array_to_string(fr.f, ','), '') AS fragments
FROM ov JOIN (SELECT doc_id, doc_id % 40 AS page_id FROM documents) dp ON CAST(dp.doc_id AS VARCHAR) = ov.q_id LEFT JOIN im ON im.q_id = ov.q_id LEFT JOIN fr ON fr.q_id = ov.q_id""",
)
def flag_context(spark, d):
    pages = table(spark, d, "documents").select(s(F.col("doc_id")).alias("q_id"), (F.col("doc_id") % 40).alias("page"))
    images = table(spark, d, "lineitem").select(s(F.col("l_partkey")).alias("q_id"), F.col("l_suppkey").alias("file"))
    fragments = table(spark, d, "conversations").select(s(F.col("conv_id")).alias("q_id"), F.col("turn").alias("fragment"))
    out = G.context(_decided(spark, d).select("flag_key", "q_id"), pages, images, fragments)
    return out.select("flag_key", "q_id", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("pages", "images", "fragments")])


@query(
    "trimmed_tails",
    f"""WITH t AS (SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 0 THEN 'Own territory. ' || o_orderpriority || {NL} || 'The given case of ' || o_custkey WHEN 1 THEN 'The given case of ' || o_custkey ELSE o_orderpriority END AS solution FROM orders)
SELECT id, CASE WHEN id % 3 = 0 THEN rtrim(substr(solution, 1, strpos(solution, 'The given case') - 1), ' ' || {NL}) ELSE solution END AS healed, CASE WHEN id % 3 = 0 THEN substr(solution, strpos(solution, 'The given case')) END AS archived FROM t""",
)
def trimmed_tails(spark, d):
    k, c = F.col("o_orderkey"), F.concat(F.lit("The given case of "), s(F.col("o_custkey")))
    text = F.when(k % 3 == 0, F.concat(F.lit("Own territory. "), F.col("o_orderpriority"), F.lit("\n"), c)).when(k % 3 == 1, c).otherwise(F.col("o_orderpriority"))
    return H.trim_tail(table(spark, d, "orders").select(k.alias("id"), text.alias("solution")), "Own territory.", "The given case").drop("solution")


@query("relabelled_lines", f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'Option B: ' || o_orderpriority || {NL} || 'Option D: Early signs rule it out.' ELSE 'Option C: Early signs may rule it out.' END AS healed FROM orders")
def relabelled_lines(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 2 == 0, F.concat(F.lit("Option B: "), F.col("o_orderpriority"), F.lit("\nOption C: Early signs rule it out."))).otherwise("Option C: Early signs may rule it out.")
    return H.relabel(table(spark, d, "orders").select(k.alias("id"), text.alias("solution")), "Option C: Early signs rule it out.", "D").drop("solution")
