"""Operators over numbered records: numbering, duplicates, density, splits, grades, completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions.text import blank, contamination


def numbering_gaps(rows: DataFrame, by: str = "chapter", number: str = "q_no") -> DataFrame:
    """Missing numbers between the least and the greatest of each chapter: chapter, from_no, to_no (inclusive runs).

    Distinct numbers are ordered inside a chapter; only the ends of gaps are rows, so a wide gap is one.
    """
    n = rows.where(F.col(number).isNotNull()).select(by, number).distinct()
    nxt = F.lead(number).over(Window.partitionBy(by).orderBy(number))
    n = n.withColumn("next", nxt).where(F.col("next") > F.col(number) + 1)
    return n.select(by, (F.col(number) + 1).alias("from_no"), (F.col("next") - 1).alias("to_no"))


def numbering_start(rows: DataFrame, by: str = "chapter", number: str = "q_no") -> DataFrame:
    """Chapters that do not begin at 1: chapter, first_no."""
    return rows.groupBy(by).agg(F.min(number).alias("first_no")).where("first_no <> 1")


def duplicates(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def connected_runs(rows: DataFrame, by: str = "chapter", number: str = "q_no", least: int = 5) -> DataFrame:
    """Islands of consecutive numbers: chapter, first_no, last_no, size, trusted.

    A run is trusted with enough members or where it touches the chapter's greatest number.
    """
    n = rows.where(F.col(number).isNotNull()).select(by, number).distinct()
    w = Window.partitionBy(by).orderBy(number)
    n = n.withColumn("island", F.col(number) - F.row_number().over(w))
    runs = n.groupBy(by, "island").agg(F.min(number).alias("first_no"), F.max(number).alias("last_no"), F.count("*").alias("size"))
    top = F.max("last_no").over(Window.partitionBy(by))
    return runs.withColumn("trusted", (F.col("size") >= least) | (F.col("last_no") == top)).drop("island")


def upper_median(rates: Column) -> Column:
    """The element at half the length of a sorted list (the upper of two middles)."""
    return F.get(F.array_sort(rates), F.floor(F.size(rates) / 2).cast("int"))


def density(rates: DataFrame) -> DataFrame:
    """``rates (chapter, rate)`` with median and alarm: a rate at or above both the least bound and thrice the median.

    One value a chapter is gathered: the list grows with the number of chapters, not of rows.
    """
    median = rates.agg(upper_median(F.collect_list("rate")).alias("median"))
    bound = F.greatest(F.lit(P.SUSPECT_DENSITY_MIN), F.col("median") * P.SUSPECT_DENSITY_MULT)
    return rates.crossJoin(F.broadcast(median)).withColumn("alarm", F.col("rate") >= bound)


def answer_key_only(rows: DataFrame, by: str = "chapter") -> DataFrame:
    """``rows (chapter, answer, solution)``: whether a chapter prints answers without explanations."""
    answered = ~blank("answer")
    g = rows.groupBy(by).agg(
        F.count("*").alias("n"), F.count_if(answered).alias("answered"), F.count_if(answered & blank("solution")).alias("bare"), F.count_if(blank("solution")).alias("missing")
    )
    only = (F.col("n") >= P.ANSWER_KEY_ONLY_MIN_ROWS) & (F.col("answered") > 0) & (F.col("bare") >= F.col("answered") * P.ANSWER_KEY_ONLY_MIN_SHARE)
    return g.withColumn("key_only", only)


def key_check(extracted: DataFrame, printed: DataFrame, by: str = "chapter") -> DataFrame:
    """Extracted answers against a printed key, by chapter: keyrows, strays, missing, matched, flipped.

    A stray has a number above the chapter's count of records.
    """
    size = extracted.groupBy(by).agg(F.count("*").alias("n"))
    k = printed.join(size, by, "left").withColumn("stray", F.col("q_no") > F.coalesce("n", F.lit(0)))
    e = extracted.select(by, "q_no", "answer")
    both = k.join(e, [by, "q_no"], "left")
    hit = ~F.col("stray") & F.col("answer").isNotNull()
    return both.groupBy(by).agg(
        F.count("*").alias("keyrows"),
        F.count_if("stray").alias("strays"),
        F.count_if(~F.col("stray") & F.col("answer").isNull()).alias("missing"),
        F.count_if(hit & (F.col("answer") == F.col("key"))).alias("matched"),
        F.count_if(hit & (F.col("answer") != F.col("key"))).alias("flipped"),
    )


def id_consistency(a: DataFrame, b: DataFrame, c: DataFrame, key: str = "id") -> DataFrame:
    """Ids that only one of three tables has, and (strict) those missing in any: id, in_a, in_b, in_c, only_one."""
    mark = lambda df, name: df.select(key).distinct().select(key, F.lit(True).alias(name))
    out = mark(a, "in_a").join(mark(b, "in_b"), key, "full").join(mark(c, "in_c"), key, "full")
    out = out.select(key, *[F.coalesce(x, F.lit(False)).alias(x) for x in ("in_a", "in_b", "in_c")])
    n = sum((F.col(x).cast("int") for x in ("in_a", "in_b", "in_c")), F.lit(0))
    return out.where(n < 3).withColumn("only_one", n == 1)


def status(missing: dict[str, Column]) -> tuple[Column, Column]:
    """(extraction_status, missing_fields) from conditions by field."""
    fields = F.array_compact(F.array(*[F.when(c, k) for k, c in missing.items()]))
    return F.when(F.size(fields) == 0, "COMPLETE").otherwise("INCOMPLETE"), fields


ANCHORS = ("printed_stem", "printed_header", "key_row", "ocr_stem", "ocr_header")


def grade(rows: DataFrame) -> DataFrame:
    """``rows`` with five anchor booleans, run, carry, stem, options, answer, solution: with grade and reason.

    No anchor: resolved by a run or carry, else provisional, and unresolved where the question's
    side is empty. Two anchors with a printed stem or header: anchored. A record whose only printed anchor is
    a solution header and that lacks options or answer is unresolved: its question is elsewhere.
    """
    n = sum((F.col(a).cast("int") for a in ANCHORS), F.lit(0))
    g = (
        F.when((n == 0) & (F.col("run") | F.col("carry")), "RESOLVED")
        .when(n == 0, "PROVISIONAL")
        .when((n >= 2) & (F.col("printed_stem") | F.col("printed_header")), "RESOLVED_ANCHORED")
        .otherwise("RESOLVED")
    )
    rows = rows.withColumn("grade", g)
    empty = blank("stem") & blank("options")
    lost = (F.col("grade") == "PROVISIONAL") & empty & (n == 0)
    phantom = F.col("grade").startswith("RESOLVED") & F.col("printed_header") & ~F.col("printed_stem") & ~F.col("key_row") & (blank("options") | blank("answer"))
    reason = F.when(lost & blank("solution"), "no_anchor_at_all").when(lost | phantom, "missing_question_for_solution")
    return rows.withColumn("reason", reason).withColumn("grade", F.when(F.col("reason").isNotNull(), "UNRESOLVED").otherwise(F.col("grade")))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` in a global order, with ``place`` from 1: rows are dealt out by ranges of the order, ranked inside a range, and ranges are offset by the sizes of those before.

    The first column of the order alone makes the ranges, so equal values of it stay together. Only one count a range is gathered.
    """
    first = order[0]
    size = rows.groupBy(first).agg(F.count("*").alias("_n"))
    cuts = rows.select(F.percentile_approx(first, [i / 64 for i in range(1, 64)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col(first))) if cuts else F.lit(0)
    per = size.withColumn("_at", at).groupBy("_at").agg(F.sum("_n").alias("_n"))
    per = per.withColumn("_before", F.sum("_n").over(Window.orderBy("_at")) - F.col("_n")).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_at").orderBy(*order))
    return rows.withColumn("_at", at).withColumn("_r", rank).join(F.broadcast(per), "_at").withColumn("place", F.col("_before") + F.col("_r")).drop("_at", "_r", "_before")


def first_rows(rows: DataFrame, key: str, *order: Column | str) -> DataFrame:
    """Keep-first dedupe; rows without a key are dropped."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.where(F.col(key).isNotNull()).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def last_by(rows: DataFrame, key: str, position: Column, *columns: str) -> DataFrame:
    """Keep-last by position, as one aggregation: partial on each task, so hot keys do not gather."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*columns), position).alias("_l")).select(key, "_l.*")


def fill_only(rows: DataFrame, key: str, position: Column, fields: list[str]) -> DataFrame:
    """Merge items of a key: each field takes its first non-blank value, nothing is overwritten."""
    first = lambda f: F.min_by(f, F.when(~blank(F.col(f).cast("string")), position)).alias(f)
    return rows.groupBy(key).agg(*[first(f) for f in fields])


def split_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Questions, answers and solutions of ``rows (q_id, chapter, q_no, stem, options map, answer, solution)``.

    The three tables have the same ids and each its own status; options are padded to A-D.
    """
    opts = F.transform(F.array(*map(F.lit, "ABCD")), lambda k: F.struct(k.alias("id"), F.coalesce(F.try_element_at("options", k), F.lit("")).alias("text")))
    rows = rows.withColumn("padded", opts)
    head = ["q_id", "chapter", "q_no"]
    st, mf = status({"question_text": blank("stem"), "options": F.exists("padded", lambda o: blank(o["text"]))})
    questions = rows.select(*head, F.col("stem").alias("question_text"), F.to_json("padded").alias("options"), st.alias("extraction_status"), F.array_join(mf, ",").alias("missing_fields"))
    st, mf = status({"correct_option": blank("answer")})
    answers = rows.select(*head, F.col("answer").alias("correct_option"), st.alias("extraction_status"), F.array_join(mf, ",").alias("missing_fields"))
    st, mf = status({"solution_text": blank("solution")})
    solutions = rows.select(*head, F.col("solution").alias("solution_text"), st.alias("extraction_status"), F.array_join(mf, ",").alias("missing_fields"))
    return questions, answers, solutions


def completeness(questions: DataFrame, answers: DataFrame, solutions: DataFrame) -> DataFrame:
    """Chapter roll-up of the three tables in one pass: records and incomplete rows of each."""
    part = lambda df, name: df.select("chapter", F.lit(name).alias("t"), (F.col("extraction_status") == "INCOMPLETE").alias("bad"))
    every = part(questions, "q").unionByName(part(answers, "a")).unionByName(part(solutions, "s"))
    names = {"q": "question", "a": "answer", "s": "solution"}
    aggs = [F.count_if(F.col("t") == t).alias(f"{n}_records") for t, n in names.items()]
    aggs += [F.count_if((F.col("t") == t) & F.col("bad")).alias(f"{n}_incomplete") for t, n in names.items()]
    return every.groupBy("chapter").agg(*aggs)


def rubric(rollup: DataFrame, questions: DataFrame, answers: DataFrame, solutions: DataFrame) -> DataFrame:
    """The seven checks of a split chapter: chapter, failed (names, in order), passed.

    rollup: chapter, files (names that are there), grade_counts (map), question_records, pending (anchors not wired yet),
    statuses (that occur), unresolved (numbers). The three tables (chapter, q_id) must not hold an id that
    the two others lack.
    """
    mark = lambda df, bit: df.select("chapter", "q_id", F.lit(bit).alias("t"))
    every = mark(questions, 1).unionByName(mark(answers, 2)).unionByName(mark(solutions, 4))
    lone = every.groupBy("chapter", "q_id").agg(F.bit_or("t").alias("t")).where(F.col("t").isin(1, 2, 4)).select("chapter").distinct().withColumn("lone", F.lit(True))
    j = rollup.join(lone, "chapter", "left")
    total = F.aggregate(F.map_values("grade_counts"), F.lit(0).cast("long"), lambda acc, n: acc + n)
    n = F.col("unresolved")
    checks = {
        "files_exist": F.size(F.array_except(F.array(*map(F.lit, P.SPLIT_FILES)), "files")) == 0,
        "grade_values": F.size(F.array_except(F.map_keys("grade_counts"), F.array(*map(F.lit, P.GRADES)))) == 0,
        "grade_sum": total == F.col("question_records"),
        "phase2_pending": F.size("pending") == 0,
        "extraction_status": F.size(F.array_except("statuses", F.array(*map(F.lit, P.STATUSES)))) == 0,
        "qid_set_consistency": F.col("lone").isNull(),
        "unresolved_qids": (n == F.array_sort(n)) & (F.size(F.array_distinct(n)) == F.size(n)),
    }
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]))
    return j.select("chapter", F.array_join(failed, ",").alias("failed"), (F.size(failed) == 0).alias("passed"))


def incomplete(rows: DataFrame, gate: float = P.SOLUTION_GATE) -> DataFrame:
    """Missing fields by record; a solution gap counts only where enough of the chapter has solutions or a header was printed.

    rows: chapter, q_no, stem, options (map; A to D must be filled), answer, solution, printed. A stem that is really solution prose is missing, too.
    Rows: chapter, q_no, missing.
    """
    share = rows.groupBy("chapter").agg(F.avg(F.when(blank("solution"), 0.0).otherwise(1.0)).alias("share"))
    j = rows.join(share, "chapter")
    gap = blank("solution") & ((F.col("share") >= gate) | F.col("printed"))
    open_ = F.exists(F.array(*map(F.lit, "ABCD")), lambda k: blank(F.try_element_at("options", k)))
    prose = contamination(F.col("stem"), F.col("solution")).isNotNull()
    _, fields = status({"stem": blank("stem") | prose, "options": F.coalesce(open_, F.lit(True)), "answer": blank("answer"), "solution": gap})
    return j.where(F.size(fields) > 0).select("chapter", "q_no", F.array_join(fields, ",").alias("missing"))
