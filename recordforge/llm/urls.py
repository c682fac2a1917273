"""URL filters: a tree of path templates for each host, judged by labelled purity.

Paths become branches of up to DEPTH segments. Segments that vary are generalised: digits by
form, and where a node has more than FANOUT different children, those with a small share of its URLs
become a wildcard. Sibling branches with the same rest whose share of bad labels does not differ
significantly from that of the others are merged, if they and the others have EVIDENCE labels each: a
branch with few labels tells nothing, so it stays by itself and its host's prior speaks for it. A template is blocked where its share of bad
labels, smoothed towards its host's and that towards the whole corpus', reaches BLOCK.

All is counted with partial sums over (host, template); every later step works on that table.
Verdicts come back by a join on its unique keys, so a host with a third of all URLs is split
like any other skewed join side. Whole paths count: what lies below DEPTH is one last segment.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

DEPTH = 5
FANOUT = 30
#: A child of a wide node keeps its name if it has at least this share of the node's URLs.
SHARE = 0.05
#: Two-sided 5 % bound of the normal distribution.
Z = 1.96
#: Labels that a branch, and the others together, must have to be compared.
EVIDENCE = 8
#: Labels that a prior weighs as much as.
PRIOR = 10.0
BLOCK = 0.5
#: Rules of the query: verdict, host, path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_SEGMENTS = [f"s{i}" for i in range(1, DEPTH + 1)]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(urls: DataFrame) -> DataFrame:
    """``urls (url, ...)`` with host (A-Z lower-cased) and path; both empty without ``://`` and for null."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.char_length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return urls.withColumn("host", host).withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host and path, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # a longer rule is asked before the shorter ones
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def with_segments(urls: DataFrame) -> DataFrame:
    """Columns s1 .. sDEPTH: the path's segments with digits generalised; empty ones are left out."""
    plain = F.regexp_replace(F.regexp_replace("path", "/+", "/"), "^/|/$", "")
    plain = F.regexp_replace(plain, "[0-9]+", "{n}")
    plain = F.regexp_replace(plain, r"[^/]*(?:\{n\}[^/]*){3,}", "{x}")
    parts = F.split(plain, "/", DEPTH)
    return urls.withColumns({s: F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i, s in enumerate(_SEGMENTS)})


def templates(urls: DataFrame) -> DataFrame:
    """The template table: host, s1 .. (as in the URLs), t1 .. (generalised), purity, blocked.

    urls: host, s1 .., bad (1, 0 or null where there is no label). The row of a host and branch is unique.
    """
    seen = urls.groupBy("host", *_SEGMENTS).agg(F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    t = common.written(seen, "url-branches")
    t = t.withColumns({f"t{i}": F.col(s) for i, s in enumerate(_SEGMENTS, 1)})
    names = [f"t{i}" for i in range(1, DEPTH + 1)]
    for i, name in enumerate(names):
        node = ["host", *names[:i]]
        child = t.where(F.col(name) != "").groupBy(*node, name).agg(F.sum("n").alias("c"))
        wide = child.groupBy(*node).agg(F.count("*").alias("kinds"), F.sum("c").alias("whole")).where(F.col("kinds") > FANOUT)
        light = child.join(wide, node).where(F.col("c") < F.col("whole") * SHARE).select(*node, name, F.lit(True).alias("light"))
        light = common.written(light, "url-light")
        if not light.isEmpty():
            t = t.join(light, [*node, name], "left").withColumn(name, F.when(F.col("light"), "*").otherwise(F.col(name))).drop("light")
            t = common.written(t, "url-general")
    tree = t.groupBy("host", *names).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")).withColumns({f"m{i}": F.col(n) for i, n in enumerate(names, 1)})
    tree = common.written(tree, "url-tree")
    merged = [f"m{i}" for i in range(1, DEPTH + 1)]
    for name in reversed(merged):
        rest = ["host", *[m for m in merged if m != name]]
        branch = tree.where(F.col(name) != "").groupBy(*rest, name).agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
        all_ = branch.groupBy(*rest).agg(F.count("*").alias("kinds"), F.sum("l").alias("al"), F.sum("b").alias("ab")).where("kinds > 1")
        pair = branch.join(all_, rest).withColumn("ol", F.col("al") - F.col("l")).withColumn("ob", F.col("ab") - F.col("b"))
        p = (F.col("ab") + 1.0) / (F.col("al") + 2.0)
        gap = F.abs((F.col("b") + p) / (F.col("l") + 1.0) - (F.col("ob") + p) / (F.col("ol") + 1.0))
        like = gap <= Z * F.sqrt(p * (1.0 - p) * (1.0 / (F.col("l") + 1.0) + 1.0 / (F.col("ol") + 1.0)))
        pair = common.written(pair.where(like & (F.col("l") >= EVIDENCE) & (F.col("ol") >= EVIDENCE)).select(*rest, name, F.lit(True).alias("like")), "url-like")
        if not pair.isEmpty():
            tree = tree.join(pair, [*rest, name], "left").withColumn(name, F.when(F.col("like"), "+").otherwise(F.col(name))).drop("like")
            tree = common.written(tree, "url-tree")
    total = tree.agg(((F.sum("bad") + 1.0) / (F.sum("labelled") + 2.0)).alias("everywhere"))
    hosts = tree.groupBy("host").agg(F.sum("labelled").alias("hl"), F.sum("bad").alias("hb"))
    hosts = hosts.crossJoin(F.broadcast(total)).select("host", ((F.col("hb") + PRIOR * F.col("everywhere")) / (F.col("hl") + PRIOR)).alias("prior"))
    pure = tree.groupBy("host", *merged).agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).join(hosts, "host")
    pure = pure.select("host", *merged, ((F.col("b") + PRIOR * F.col("prior")) / (F.col("l") + PRIOR)).alias("purity"))
    named = t.select("host", *_SEGMENTS, *names).join(tree.select("host", *names, *merged), ["host", *names])
    named = named.join(pure, ["host", *merged])
    return named.select("host", *_SEGMENTS, *[F.col(m).alias(f"t{i}") for i, m in enumerate(merged, 1)], "purity", (F.col("purity") >= BLOCK).alias("blocked"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """Verdicts for ``pages (page_id, url)``: page_id, host, path, rule, verdict, template, purity.

    labels: doc_id, bad (1 bad, 0 good); the last number in a path is the id of the document that
    the page shows. Repeated labels of an id count as bad if one is. Null and broken URLs
    have an empty host and path and are judged together; repeated rows and ids are judged each;
    an empty table gives no rows.
    """
    urls = with_segments(with_parts(pages.select("page_id", "url")))
    number = F.expr(r"try_cast(regexp_extract(path, r'([0-9]{1,18})(?:\.[A-Za-z]+)?/?$', 1) as bigint)")
    labels = labels.groupBy("doc_id").agg(F.max("bad").alias("bad")).where("doc_id is not null")
    urls = common.written(urls.drop("url").withColumn("doc_id", number).join(labels, "doc_id", "left").drop("doc_id"), "url-parts")
    tree = common.written(templates(urls), "url-templates")
    out = urls.join(tree, ["host", *_SEGMENTS])
    rule, verdict = rule_of(rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    shape = reduce(lambda a, i: F.concat(a, F.when(F.col(f"t{i}") != "", F.concat(F.lit("/"), f"t{i}")).otherwise("")), range(1, DEPTH + 1), F.col("host"))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), shape.alias("template"), "purity")


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages judged by the rules, else by their templates' purity; both are in the result."""
    labels = common.table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    out = judge(common.table(spark, sf_dir, "pages", "page_id", "url"), labels.select("doc_id", bad.cast("long").alias("bad")))
    return out.select("page_id", "host", "path", "rule", "verdict", "template", F.round("purity", 9).alias("purity"))


def _oracle() -> str:
    """The same result in DuckDB SQL, a step for each level of the tree."""
    seg = ", ".join(_SEGMENTS)
    ts, ms = [f"t{i}" for i in range(1, DEPTH + 1)], [f"m{i}" for i in range(1, DEPTH + 1)]
    steps = [
        r"""u AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages))""",
        r"""v AS (
  SELECT *, try_cast(regexp_extract(path, '([0-9]{1,18})(?:\.[A-Za-z]+)?/?$', 1) AS BIGINT) AS doc,
         string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '/+', '/', 'g'), '^/|/$', '', 'g'), '[0-9]+', '{n}', 'g'),
                                     '[^/]*(?:\{n\}[^/]*){3,}', '{x}', 'g'), '/') AS a FROM u)""",
        """lab AS (
  SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad
  FROM labels GROUP BY doc_id)""",
        "s AS (SELECT v.page_id, host, path, bad, "
        + ", ".join(f"coalesce(a[{i}], '') AS s{i}" for i in range(1, DEPTH))
        + f", coalesce(array_to_string(a[{DEPTH}:], '/'), '') AS s{DEPTH} FROM v LEFT JOIN lab ON doc = lab.doc_id)",
        f"g0 AS (SELECT host, {seg}, {', '.join(f's{i} AS t{i}' for i in range(1, DEPTH + 1))}, count(*) AS n, count(bad) AS l, coalesce(sum(bad), 0) AS b FROM s GROUP BY ALL)",
    ]
    for i, t in enumerate(ts):
        node = ", ".join(["host", *ts[:i]])
        rest = ", ".join([*_SEGMENTS, *[x for x in ts if x != t], "n", "l", "b"])
        steps.append(
            f"g{i + 1} AS (SELECT host, {rest}, CASE WHEN {t} <> '' AND kinds > {FANOUT} AND c < whole * {SHARE} THEN '*' ELSE {t} END AS {t} FROM ("
            f"SELECT *, sum(n) OVER (PARTITION BY {node}, {t}) AS c, sum(CASE WHEN {t} <> '' THEN n END) OVER (PARTITION BY {node}) AS whole, "
            f"count(DISTINCT nullif({t}, '')) OVER (PARTITION BY {node}) AS kinds FROM g{i}))"
        )
    steps.append(f"k{DEPTH} AS (SELECT host, {', '.join(ts)}, {', '.join(f't{i} AS m{i}' for i in range(1, DEPTH + 1))}, sum(l) AS l, sum(b) AS b FROM g{DEPTH} GROUP BY ALL)")
    for i in range(DEPTH, 0, -1):
        m, rest = f"m{i}", ", ".join(["host", *[x for x in ms if x != f"m{i}"]])
        cols = ", ".join([*ts, "l", "b"])
        p = "((ab + 1.0) / (al + 2.0))"
        steps.append(
            f"k{i - 1} AS (SELECT {rest}, {cols}, CASE WHEN {m} <> '' AND kinds > 1 AND abs((bb + {p}) / (bl + 1.0) - (ab - bb + {p}) / (al - bl + 1.0)) <= "
            f"{Z} * sqrt({p} * (1.0 - {p}) * (1.0 / (bl + 1.0) + 1.0 / (al - bl + 1.0))) AND bl >= {EVIDENCE} AND al - bl >= {EVIDENCE} THEN '+' ELSE {m} END AS {m} FROM ("
            f"SELECT *, sum(l) OVER (PARTITION BY {rest}, {m}) AS bl, sum(b) OVER (PARTITION BY {rest}, {m}) AS bb, "
            f"sum(CASE WHEN {m} <> '' THEN l END) OVER (PARTITION BY {rest}) AS al, sum(CASE WHEN {m} <> '' THEN b END) OVER (PARTITION BY {rest}) AS ab, "
            f"count(DISTINCT nullif({m}, '')) OVER (PARTITION BY {rest}) AS kinds FROM (SELECT host, {', '.join(ts)}, {', '.join(ms)}, CAST(l AS DOUBLE) AS l, CAST(b AS DOUBLE) AS b FROM k{i})))"
        )
    shape = "k0.host || " + " || ".join(f"CASE WHEN k0.{m} <> '' THEN '/' || k0.{m} ELSE '' END" for m in ms)
    steps += [
        "e AS (SELECT (sum(b) + 1.0) / (sum(l) + 2.0) AS everywhere FROM k0)",
        f"h AS (SELECT host, (sum(b) + {PRIOR} * any_value(everywhere)) / (sum(l) + {PRIOR}) AS prior FROM k0, e GROUP BY host)",
        f"q AS (SELECT k0.host, {', '.join(ms)}, (sum(b) + {PRIOR} * any_value(prior)) / (sum(l) + {PRIOR}) AS purity FROM k0 JOIN h ON k0.host = h.host GROUP BY ALL)",
        f"z AS (SELECT DISTINCT g.host, {', '.join('g.' + x for x in _SEGMENTS)}, {shape} AS template, purity FROM g{DEPTH} g JOIN k0 ON g.host = k0.host AND "
        + " AND ".join(f"g.{t} = k0.{t}" for t in ts)
        + " JOIN q ON q.host = k0.host AND "
        + " AND ".join(f"q.{m} = k0.{m}" for m in ms)
        + ")",
    ]
    fits = lambda h, p: f"(s.host = '{h}' OR ends_with(s.host, '.{h}')) AND starts_with(path, '{p}')"
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered)
    return (
        "WITH " + ",\n".join(steps) + f"\nSELECT page_id, s.host, path, CASE {rule} END AS rule, CASE {verdict} WHEN purity >= {BLOCK} THEN 'block' ELSE 'allow' END AS verdict, template, round(purity, 9) AS purity\n"
        "FROM s JOIN z ON s.host = z.host AND " + " AND ".join(f"s.{x} = z.{x}" for x in _SEGMENTS)
    )


ORACLE = _oracle()
