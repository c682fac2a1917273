"""The data-quality rule engine: a registry from flag kind to a native predicate.

Rules are columns over one record, so all of them run in one pass; each that holds adds a flag to an array
that is exploded. New rules are registered, not wired in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X
from recordforge.functions.text import blank, let, text, tokens

HIGH, LOW = "high", "low"
ROW_RULES: dict[str, tuple[str, Callable[[], Column]]] = {}


def rule(kind: str, severity: str = HIGH):
    def put(fn: Callable[[], Column]):
        ROW_RULES[kind] = (severity, fn)
        return fn

    return put


def _letters() -> Column:
    return F.array_sort(F.array_distinct(F.transform("options", lambda o: F.upper(X.strip(text(o["id"]))))))


def _option(letter: Column) -> Column:
    """Text of the last option with a letter."""
    return F.element_at(F.transform(F.filter("options", lambda o: F.upper(X.strip(text(o["id"]))) == letter), lambda o: text(o["text"])), -1)


def _has(letter: Column) -> Column:
    return F.exists("options", lambda o: F.upper(X.strip(text(o["id"]))) == letter)


def _long(c: Column) -> Column:
    return F.filter(tokens(c), lambda t: F.char_length(t) > 2)


rule("qa_incomplete")(lambda: F.col("qa_status") == "INCOMPLETE")
rule("qa_review_needed", LOW)(lambda: F.col("qa_status") == "REVIEW_NEEDED")
rule("empty_question")(lambda: blank("stem"))
rule("suspect_stem")(lambda: ~blank("stem_suspect"))
rule("options_suspect")(lambda: ~blank("options_suspect"))
rule("missing_answer")(lambda: F.size("correct") <= 0)
rule("missing_solution")(lambda: blank("solution"))
rule("ocr_noise_solution")(lambda: ~blank("solution") & (F.size(X.noise_lines(F.col("solution"))) > 0))
rule("contaminated_question")(lambda: X.contamination(F.col("stem"), F.col("solution")).isNotNull())
rule("over_attributed_images", LOW)(lambda: F.col("question_images") > P.CEILING_QUESTION)
rule("over_attributed_solution_images", LOW)(lambda: F.col("solution_images") > P.CEILING_SOLUTION)
rule("declared_figure_missing", LOW)(lambda: (F.col("declared_question") & (F.col("question_images") == 0)) | (F.col("declared_solution") & (F.col("solution_images") == 0)))


@rule("bad_options")
def _bad_options() -> Column:
    full = F.size(F.filter("options", lambda o: ~blank(o["text"])))
    return (F.size("options") != 4) | (F.array_join(_letters(), "") != "ABCD") | (full != 4)


@rule("blank_correct_option")
def _blank_correct() -> Column:
    first = lambda k: F.get(F.filter("options", lambda o: F.upper(X.strip(text(o["id"]))) == F.upper(X.strip(k))), F.lit(0))
    return F.exists("correct", lambda k: blank(first(k)["text"]))


@rule("answer_mismatch")
def _mismatch() -> Column:
    return (F.size("correct") > 0) & F.exists("correct", lambda k: ~F.array_contains(_letters(), F.upper(X.strip(k))))


def _ending() -> Column:
    return X.truncation(F.col("solution"), F.size("tables") > 0, F.col("solution_images") > 0)


rule("truncated_solution")(lambda: _ending() == "truncated_solution")
rule("short_bare_solution", LOW)(lambda: _ending() == "short_bare_solution")


def _header_at() -> Column:
    return F.regexp_instr(text("solution"), F.lit(P.SOLUTION_TO_QUESTION))


rule("solution_header_furniture", LOW)(lambda: _header_at().between(1, 3))
rule("solution_recitation_dump")(lambda: _header_at() > 3)


@rule("foreign_option_head")
def _foreign_head() -> Column:
    letter = F.upper(F.regexp_extract(X.strip(text("solution")), P.OPTION_LINE_START, 1))
    head = F.array_join(F.slice(tokens(F.col("solution")), 1, 25), " ")

    def judge(x: Column) -> Column:
        return (F.size(x["own"]) > 0) & ~F.exists(F.slice(x["own"], 1, 6), lambda t: F.contains(x["head"], t))

    return (letter != "") & _has(letter) & let(F.struct(_long(_option(letter)).alias("own"), head.alias("head")), judge)


@rule("option_solution_disagree")
def _disagree() -> Column:
    """A segment after an option label that has none of the first six words of that option."""
    parts = F.split(text("solution"), P.OPTION_LINE_ANY, -1)
    letters = F.transform(F.regexp_extract_all(text("solution"), F.lit(P.OPTION_LINE_ANY), F.lit(0)), lambda m: F.upper(F.regexp_extract(m, P.OPTION_LINE_ANY, 1)))
    pairs = F.arrays_zip(letters.alias("k"), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))).alias("seg"))

    def odd(p: Column) -> Column:
        own = _long(_option(p["k"]))
        seg = F.lower(F.substring(text(p["seg"]), 1, 200))
        return let(F.struct(own.alias("own"), seg.alias("seg")), lambda x: (F.size(x["own"]) >= 3) & ~F.exists(F.slice(x["own"], 1, 6), lambda t: F.contains(x["seg"], t)))

    return F.exists(F.filter(pairs, lambda p: _has(p["k"])), odd)


@rule("duplicate_table", LOW)
def _dup_table() -> Column:
    keys = F.filter(F.transform("tables", lambda t: MD.table_key(t["markdown"])), lambda k: k != "")
    return F.size(keys) > F.size(F.array_distinct(keys))


rule("stray_answer_key_table", LOW)(lambda: F.exists("tables", lambda t: MD.is_answer_key(t["markdown"], t["type"])))

RECORD = (
    "chapter string, q_no long, stem string, options array<struct<id:string,text:string>>, correct array<string>, solution string, "
    "tables array<struct<type:string,markdown:string>>, question_images int, solution_images int, declared_question boolean, declared_solution boolean, "
    "qa_status string, stem_suspect string, options_suspect string"
)


def row_flags(records: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """Flags of ``records`` (columns of RECORD): chapter, q_no, kind, severity; all rules in one pass."""
    picked = {k: v for k, v in ROW_RULES.items() if kinds is None or k in kinds}
    each = [F.when(F.coalesce(fn(), F.lit(False)), F.struct(F.lit(k).alias("kind"), F.lit(s).alias("severity"))) for k, (s, fn) in picked.items()]
    return records.select("chapter", "q_no", F.explode(F.array_compact(F.array(*each))).alias("f")).select("chapter", "q_no", "f.*")


def flag_summary(flags: DataFrame) -> DataFrame:
    """Flags by kind: kind, severity, flags, chapters."""
    return flags.groupBy("kind", "severity").agg(F.count("*").alias("flags"), F.count_distinct("chapter").alias("chapters"))


def upgrade_severity(flags: DataFrame, pages: DataFrame, hot: DataFrame) -> DataFrame:
    """``declared_figure_missing`` becomes high where a hot page lies on or beside the record's own pages.

    flags: chapter, q_no, kind, severity, pos (emission order); pages: chapter, q_no, first_page, last_page; hot: chapter,
    page. Of several such flags of a record only the last is upgraded.
    """
    near = pages.join(hot, "chapter").where(F.col("page").between(F.col("first_page") - 1, F.col("last_page") + 2))
    near = near.select("chapter", "q_no").distinct().withColumn("near", F.lit(True))
    last = flags.where("kind = 'declared_figure_missing'").groupBy("chapter", "q_no").agg(F.max("pos").alias("last_pos"))
    out = flags.join(near, ["chapter", "q_no"], "left").join(last, ["chapter", "q_no"], "left")
    up = (F.col("kind") == "declared_figure_missing") & F.col("near") & (F.col("pos") == F.col("last_pos"))
    return out.withColumn("severity", F.when(up, HIGH).otherwise(F.col("severity"))).drop("near", "last_pos")
