"""Anchors in page text: harvest, printed keys, page locations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions.text import text


def _hits(page: Column, pattern: str, kind: str, letter: bool = False) -> Column:
    """Matches of a numbered pattern: (kind, q_no, letter)."""
    full = F.regexp_extract_all(text(page), F.lit(pattern), F.lit(0))
    number = lambda m: F.regexp_extract(m, pattern, 1).cast("int")
    key = (lambda m: F.upper(F.regexp_extract(m, pattern, 2))) if letter else (lambda m: F.lit(""))
    return F.transform(full, lambda m: F.struct(F.lit(kind).alias("kind"), number(m).alias("q_no"), key(m).alias("letter")))


def page_hits(page: Column) -> Column:
    """Every stem, solution header and key row of a page."""
    keys = [_hits(page, p, "answer", True) for p in (P.KEY_ROW_PIPE, P.KEY_ROW_DOT, P.KEY_ROW_DASH)]
    return F.concat(_hits(page, P.PRINTED_STEM, "question"), _hits(page, P.SOLUTION_TO_QUESTION, "solution"), *keys)


def harvest(pages: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``pages (chapter, page, text)``: the first page and letter of each anchor: chapter, q_no, kind, page, letter.

    With ``known (chapter, q_no)`` only its numbers count.
    """
    h = pages.select("chapter", "page", F.explode(page_hits(F.col("text"))).alias("h")).select("chapter", "page", "h.*")
    if known is not None:
        h = h.join(known.select("chapter", "q_no").distinct(), ["chapter", "q_no"], "left_semi")
    first = h.groupBy("chapter", "q_no", "kind").agg(F.min(F.struct("page", "letter")).alias("f"))
    return first.select("chapter", "q_no", "kind", "f.page", "f.letter")


def locate(pages: DataFrame) -> DataFrame:
    """All pages of each record: chapter, q_no, question, answer, solution (sorted page lists as text)."""
    h = pages.select("chapter", "page", F.explode(page_hits(F.col("text"))).alias("h")).select("chapter", "page", "h.q_no", "h.kind")
    own = lambda k: F.array_join(F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("page")))), ",").alias(k)
    return h.groupBy("chapter", "q_no").agg(own("question"), own("answer"), own("solution"))


def printed_key(pages: DataFrame) -> DataFrame:
    """Printed answers of pages inside a key: chapter, q_no, letter.

    The key opens on a page that names it and closes behind a page where explanations begin; both marks are running
    values over a chapter's pages. The first page that shows a number wins.
    """
    opens = F.col("text").rlike(r"(?i)Answer Key|Correct Option")
    closes = F.col("text").rlike(r"(?i)Detailed Explanations|Solution to Question")
    w = Window.partitionBy("chapter").orderBy("page")
    p = pages.withColumn("o", F.last(F.when(opens, F.col("page")), True).over(w))
    # a close ends the pages after it; where a page both opens and closes it is still inside
    p = p.withColumn("c", F.last(F.when(closes, F.col("page")), True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    p = p.where(F.col("o").isNotNull() & (F.col("c").isNull() | (F.col("o") > F.col("c"))))
    rows = F.concat(_hits(F.col("text"), P.DIGEST_ROW_GAP, "answer", True), _hits(F.col("text"), P.DIGEST_ROW_PIPE, "answer", True))
    h = p.select("chapter", "page", F.posexplode(rows).alias("i", "h")).select("chapter", "page", "i", "h.q_no", "h.letter")
    return h.groupBy("chapter", "q_no").agg(F.min_by("letter", F.struct("page", "i")).alias("letter"))
