"""Who owns what: as-of assignment, extents, caps, ranges, exact-count zips, set differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P


def as_of(left: DataFrame, right: DataFrame, by: str, at: list[str], take: list[str]) -> DataFrame:
    """Each left row with ``take`` of the last right row at or before it in its group.

    One union and one running window, never a join on an inequality. ``at``: ordering columns of both sides; on
    equal places the right row comes first.
    """
    r = right.select(by, *at, F.struct(*take).alias("_own"), F.lit(0).alias("_side"))
    cols = [c for c in left.columns if c not in (by, *at)]
    both = left.select(by, *at, F.struct(*(cols or [F.lit(1).alias("_x")])).alias("_left"), F.lit(1).alias("_side")).unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(by).orderBy(*at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_own", F.last("_own", ignorenulls=True).over(w)).where("_side = 1")
    return both.select(by, *at, *[F.col(f"_left.{c}").alias(c) for c in cols], *[F.col(f"_own.{c}").alias(c) for c in take])


def capped(claims: DataFrame, owner: list[str], order: list[Column | str], soft: int, ceiling: int, declared: str | None = None) -> DataFrame:
    """Claims with ``kept``: the first of each owner within its cap; the rest is left over.

    The cap is the soft one, raised to the ceiling where all claims so far were declared.
    """
    w = Window.partitionBy(*owner).orderBy(*order)
    claims = claims.withColumn("rank", F.row_number().over(w))
    cap = F.lit(soft) if declared is None else F.when(F.col(declared), ceiling).otherwise(soft)
    return claims.withColumn("kept", F.col("rank") <= cap)


def extents(headings: DataFrame, by: str, y: str) -> DataFrame:
    """Each heading's block: from its own place up to the next one's, exclusive (null: open)."""
    return headings.withColumn("until", F.lead(y).over(Window.partitionBy(by).orderBy(y)))


def page_ranges(chapters: DataFrame, total: Column, offset: int = 0) -> DataFrame:
    """``chapters (book, chapter_no, start)``: file_start and file_end; the last runs to the end of the book."""
    nxt = F.lead("start").over(Window.partitionBy("book").orderBy("chapter_no"))
    out = chapters.withColumn("file_start", F.col("start") + offset)
    return out.withColumn("file_end", F.coalesce(nxt + offset - 1, total)).drop("start")


def in_range(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, width: int = 64) -> DataFrame:
    """Points with every range that holds them: an equi-join on cells of ``width``, then the bounds."""
    r = ranges.withColumn("_cell", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    p = points.withColumn("_cell", F.floor(F.col(at) / width))
    return p.join(r, "_cell").where(F.col(at).between(F.col(start), F.col(end))).drop("_cell")


def first_in_range(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str, name: str) -> DataFrame:
    """Distinct points that any range holds, with the smallest ``name`` of those ranges. Points and bounds are whole numbers.

    A range is cut into aligned runs of 1, 2, 4, ... numbers, at most two of a length; a point lies in one run of each
    length. So wide and many ranges cost rows by the logarithm of their width, not by their cells. What of a range lies
    outside the points' span holds none of them and is cut off, so no run is longer than the span.
    """
    lo, hi = F.col(start).cast("long"), F.col(end).cast("long")
    p = points.where(F.col(at).isNotNull()).select(at).distinct()
    number = F.col(at).cast("long")
    span = F.col("_max").cast("decimal(20,0)") - F.col("_min").cast("decimal(20,0)") + 2  # it may not fit into 64 bits
    wide = p.agg(F.min(number).alias("_min"), F.max(number).alias("_max")).where("_min is not null")
    wide = wide.select("_min", "_max", F.least(F.lit(62), F.ceil(F.log2(span.cast("double"))).cast("int")).alias("_top"))
    level = F.explode(F.sequence(F.lit(0), F.col("_top"))).alias("_level")
    r = ranges.where((lo <= hi) & F.col(name).isNotNull()).select(name, lo.alias("_lo"), hi.alias("_hi")).crossJoin(F.broadcast(wide)).where("_lo <= _max and _hi >= _min")
    r = r.select(name, F.greatest("_lo", "_min").alias("_lo"), (F.least("_hi", "_max") + 1).alias("_hi"), level)
    left, right = F.expr("-shiftright(-_lo, _level)"), F.expr("shiftright(_hi, _level)")
    r = r.select(name, "_level", left.alias("_l"), right.alias("_r")).where("_l < _r")
    run = F.filter(F.array(F.when(F.expr("_l & 1") == 1, F.col("_l")), F.when(F.expr("_r & 1") == 1, F.col("_r") - 1)), lambda x: x.isNotNull())
    runs = r.select(name, "_level", F.explode(run).alias("_run")).groupBy("_level", "_run").agg(F.min(name).alias(name))
    p = p.crossJoin(F.broadcast(wide)).select(at, level).withColumn("_run", F.expr(f"shiftright(cast({at} as bigint), _level)"))
    # Spark's size check knows nothing of the rows by level and would hold all of them in memory
    return p.hint("merge").join(runs, ["_level", "_run"]).groupBy(at).agg(F.min(name).alias(name))


def toc_run(rows: DataFrame) -> DataFrame:
    """``rows (book, pos, no, page)``: the run that begins at 1 and goes on by one, pages never falling; others are skipped.

    A fold over a book's few lines in order; duplicates keep the first.
    """
    lines = F.array_sort(F.collect_list(F.struct("pos", "no", "page")))
    zero = F.struct(F.lit(0).alias("no"), F.lit(-1).alias("page"), F.array().cast("array<struct<no:int,page:int>>").alias("run"))

    def step(acc: Column, x: Column) -> Column:
        on = (x["no"] == acc["no"] + 1) & (x["page"] >= acc["page"])
        more = F.struct(x["no"].alias("no"), x["page"].alias("page"), F.array_append(acc["run"], F.struct(x["no"].alias("no"), x["page"].alias("page"))).alias("run"))
        return F.when(on, more).otherwise(acc)

    runs = rows.groupBy("book").agg(F.aggregate(lines, zero, step, lambda a: a["run"]).alias("run"))
    return runs.select("book", F.explode("run").alias("r")).select("book", "r.no", "r.page")


def zip_exact(declared: DataFrame, found: DataFrame, by: str, pos: str) -> DataFrame:
    """Declared entries matched to found items by order, only where a group has equally many of both."""
    rank = lambda df, n: df.withColumn("_i", F.row_number().over(Window.partitionBy(by).orderBy(pos))).withColumn(n, F.count("*").over(Window.partitionBy(by)))
    d, f = rank(declared, "_nd"), rank(found, "_nf").drop(pos)
    return d.join(f, [by, "_i"]).where("_nd = _nf").drop("_nd", "_nf", "_i")


def next_slot(names: DataFrame, prefix: Column, name: str = "name") -> Column:
    """Number after the greatest two-digit suffix behind a prefix."""
    n = F.when(F.col(name).startswith(prefix), F.regexp_extract(F.col(name), r"_(\d{2})\.webp$", 1).try_cast("int"))
    return F.coalesce(F.max(n), F.lit(0)) + 1


def section_windows(pages: DataFrame, question_size: int = 10, solution_size: int = 5) -> DataFrame:
    """``pages (chapter, first, last, solutions)``: windows (chapter, section, number, pages), one page of overlap.

    Questions run from first to the page before solutions, solutions from there to last; each window of a section but its
    first begins with the last page of the one before, the first solution window with the last question page. Without
    a solutions section there are no windows.
    """
    part = lambda s, a, b, size: F.transform(
        F.sequence(F.lit(0), F.floor((b - a) / size).cast("int")),
        lambda i: F.struct(F.lit(s).alias("section"), i.alias("number"), (a + i * size).alias("lo"), F.least(b, a + i * size + size - 1).alias("hi")),
    )
    q = F.when(F.col("solutions") > F.col("first"), part("Q", F.col("first"), F.col("solutions") - 1, question_size))
    s = part("S", F.col("solutions"), F.col("last"), solution_size)
    every = F.concat(F.coalesce(q, F.array().cast("array<struct<section:string,number:int,lo:int,hi:int>>")), s)
    w = pages.where("solutions is not null").select("chapter", "first", F.explode(every).alias("w"))
    lo = F.greatest(F.col("first"), F.col("w.lo") - 1)
    return w.select("chapter", "w.section", "w.number", F.sequence(lo, F.col("w.hi")).alias("pages"))


def should_run_questions(section: Column, overlap: Column, carry: Column, boundary: Column) -> Column:
    """Whether a window needs the question pass."""
    return F.when(section == "Q", ~boundary).otherwise(overlap | carry.isNotNull())


def pass_status(section: Column, step: Column, items: Column, error: Column, recovered: Column) -> Column:
    """Outcome of a pass over a window."""
    return (
        F.when(error & (items > 0), "RETRYABLE_FAILURE")
        .when(error & ~recovered, "UNRESOLVED")
        .when(items > 0, "SUCCESS")
        .when((section == "S") & (step == "Q"), "EXPECTED_EMPTY")
        .otherwise("PARTIAL")
    )


def witness(rows: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Rows against a witness's list, both ways: the key with ``audit_missing_question`` or ``audit_ghost_question``."""
    missing = seen.select(*key).distinct().join(rows, key, "left_anti").withColumn("kind", F.lit("audit_missing_question"))
    ghost = rows.select(*key).distinct().join(seen, key, "left_anti").withColumn("kind", F.lit("audit_ghost_question"))
    return missing.unionByName(ghost)


def adjudicate(score: Column, found: Column, truncated: Column, page: Column, duplicate: Column) -> Column:
    """What happens to a candidate: a chain, as ordered."""
    return (
        F.when(duplicate, F.when(score >= P.DELETE_AUTO_MIN, "auto").otherwise("human"))
        .when(truncated, "human")
        .when(~found, "reject")
        .when(page == "", "human")
        .when(score >= P.AUTO_APPLY_MIN, "auto")
        .when(score >= P.HUMAN_QUEUE_MIN, "human")
        .otherwise("reject")
    )


def patch_options(options: Column, fix: Column) -> Column:
    """Fill missing or blank options from a map, never overwrite. The map's letters are trimmed and upper-cased; of equal ones the first counts."""
    empty = lambda x: F.coalesce(F.trim(x), F.lit("")) == ""
    entries = F.transform(F.map_entries(fix), lambda e: F.struct(F.upper(F.trim(e["key"])).alias("key"), e["value"].alias("value")))
    letters = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    named = F.map_from_arrays(letters, F.transform(letters, lambda k: F.get(F.filter(entries, lambda e: e["key"] == k), F.lit(0))["value"]))
    return F.map_filter(F.map_zip_with(options, named, lambda k, a, b: F.when(empty(a) & ~empty(b), b).otherwise(a)), lambda k, v: v.isNotNull())
