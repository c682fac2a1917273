"""Healing rules: evidence-gated, idempotent, never overwriting; and what they change, as an archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X


def drop_tables(tables: Column) -> Column:
    """Tables (type, markdown) without answer-key tables and copies of an earlier one."""
    keyed = F.transform(tables, lambda t, i: F.struct(t.alias("t"), MD.table_key(t["markdown"]).alias("k"), i.alias("i")))
    keep = lambda x: ~MD.is_answer_key(x["t"]["markdown"], x["t"]["type"]) & ~F.exists(keyed, lambda y: (y["k"] == x["k"]) & (y["k"] != "") & (y["i"] < x["i"]))
    return F.transform(F.filter(keyed, keep), lambda x: x["t"])


def trim_dumps(rows: DataFrame) -> DataFrame:
    """``rows (chapter, q_no, solution)``: cut a solution at an embedded header of another record that has its own solution.

    The donor proves that nothing is lost; without one the text stays.
    """
    at = F.regexp_instr(X.text("solution"), F.lit(P.SOLUTION_TO_QUESTION))
    donor = F.regexp_extract(X.text("solution"), P.SOLUTION_TO_QUESTION, 1).try_cast("int")
    own = rows.where(~X.blank("solution")).select("chapter", F.col("q_no").alias("donor")).distinct().withColumn("proof", F.lit(True))
    out = rows.withColumn("donor", F.when((at > 3) & (donor != F.col("q_no")), donor)).join(own, ["chapter", "donor"], "left")
    cut = X.strip(F.substring("solution", F.lit(1), at - 1))
    return out.withColumn("healed", F.when(F.col("proof"), cut).otherwise(F.col("solution"))).select(*rows.columns, "healed")


def trim_tail(rows: DataFrame, lead: str, mark: str) -> DataFrame:
    """``rows (..., solution)`` with ``healed`` and ``archived``: where a solution holds both signatures, what begins at the mark goes into the archive."""
    at = F.instr("solution", mark)
    hit = (at > 0) & F.contains("solution", F.lit(lead))
    return rows.withColumn("healed", F.when(hit, X.rstrip(F.substring("solution", F.lit(1), at - 1))).otherwise(F.col("solution"))).withColumn("archived", F.when(hit, F.substring("solution", at, F.char_length("solution"))))


def relabel(rows: DataFrame, line: str, letter: str) -> DataFrame:
    """``rows (..., solution)`` with ``healed``: the option line gets another letter, its content stays."""
    new = f"Option {letter}" + line[len("Option X") :]
    return rows.withColumn("healed", F.replace("solution", F.lit(line), F.lit(new)))


def complete_tables(rows: DataFrame) -> DataFrame:
    """``rows (chapter, id, pos, markdown)``: a table gets the largest same-header sibling's rows if its own are a proper subset: with ``healed``.

    A text that a chapter repeats is read once, for the first two ids that have it. Texts of a chapter with equal rows are a class, whose first
    table and first of another id are all that it can give. Classes meet, not tables: one that holds all rows of another holds that one's
    rarest row, too, so they meet on it.
    """
    by, same = ["chapter", "r"], ["chapter", "text"]
    t = rows.withColumn("text", X.text("markdown"))
    header = lambda r: F.coalesce(F.get(r, F.lit(0)), F.lit(""))
    g = t.where("chapter is not null and id is not null and pos is not null").groupBy(*same, "id").agg(F.min("pos").alias("pos"))
    # always reads pos, and n % 2 below is no lower limit: so all that is made of g shares one exchange
    g = g.withColumn("n", F.row_number().over(Window.partitionBy(*same).orderBy("id"))).where("n <= 2 and pos is not null").withColumn("r", MD.table_rows(F.col("text")))
    least = F.min(F.struct("id", "pos", F.col("text").alias("markdown"))).alias("one")
    first = g.groupBy(*by).agg(least)
    other = g.join(first.select(*by, F.col("one.id").alias("first_id")), by).where("id <> first_id").groupBy(*by).agg(least)
    classes = first.select(*by).withColumn("h", header(F.col("r")))
    each = classes.select("*", F.explode(F.array_distinct(F.concat("r", F.array("h")))).alias("row"))
    count = each.groupBy("chapter", "h", "row").agg(F.count("*").alias("n"))
    asks = each.join(count, ["chapter", "h", "row"]).groupBy(*by, "h").agg(F.min_by("row", F.struct("n", "row")).alias("row"))
    has = each.select("chapter", "h", "row", F.col("r").alias("d_r"))
    met = asks.join(has, ["chapter", "h", "row"]).where((F.size("d_r") > F.size("r")) & (F.size(F.array_except("r", "d_r")) == 0)).select(*by, "d_r")
    gifts = first.unionByName(other).select("chapter", F.col("r").alias("d_r"), "one")
    given = met.join(gifts, ["chapter", "d_r"]).select(*by, F.struct(F.size("d_r"), -F.col("one.id"), -F.col("one.pos")).alias("rank"), F.col("one.id").alias("d_id"), F.col("one.markdown").alias("md"))
    best = given.groupBy(*by).agg(F.max_by(F.struct("d_id", "md"), "rank").alias("b"))
    second = given.join(best.select(*by, F.col("b.d_id").alias("b_id")), by).where("d_id <> b_id").groupBy(*by).agg(F.max_by("md", "rank").alias("next"))
    best = best.join(second, by, "left").select(*by, "b", "next")
    better = F.when(F.col("id").isNull() | F.col("pos").isNull(), None).when(F.col("b.d_id") != F.col("id"), F.col("b.md")).otherwise(F.col("next"))
    best = g.where("n % 2 = 1").select(*same, "r").join(best, by).select(*same, "b", "next")
    return t.join(best, same, "left").withColumn("healed", F.coalesce(better, "markdown")).select(*rows.columns, "healed")


def short_siblings(rows: DataFrame) -> DataFrame:
    """Tables with far fewer body rows than a same-header sibling: chapter, id, rows, largest."""
    t = rows.select("chapter", "id", MD.header_key(F.col("markdown")).alias("h"), MD.body_rows(F.col("markdown")).alias("rows"))
    top = t.groupBy("chapter", "h").agg(F.max("rows").alias("largest"))
    return t.join(top, ["chapter", "h"]).where(F.col("rows") <= F.col("largest") - P.TABLE_ROW_DEFICIT).select("chapter", "id", "rows", "largest")


def missing_paragraphs(fragment: Column, current: Column) -> Column:
    """Paragraphs of a fragment that a text does not hold yet."""
    have = X.norm(current)
    return F.filter(F.split(X.text(fragment), r"\n\s*\n"), lambda p: (X.strip(p) != "") & ~F.contains(have, X.norm(p)))


def archive(before: DataFrame, after: DataFrame, key: list[str], column: str) -> DataFrame:
    """Rows that healing changed: the key, before, after."""
    b, a = before.select(*key, F.col(column).alias("before")), after.select(*key, F.col(column).alias("after"))
    return b.join(a, key).where(~F.col("before").eqNullSafe(F.col("after")))


LADDER = ("key_table", "self_labelled", "carry", "last_question", "page_position")


def recover_orphans(orphans: DataFrame, records: DataFrame) -> DataFrame:
    """Owners of unkeyed fragments by a ladder of evidence: orphan, owner, rule, outcome.

    orphans: orphan, chapter, field, value, label, carry_no, last_no, page_no (candidate numbers, null if none). records: chapter, q_no, field,
    value (long). The first rule whose candidate exists and whose field is empty wins; page position never
    fills anything but a solution; a candidate whose field holds the value already consumes the fragment; else it is blocked.
    """
    cands = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(r).alias("rule"), F.col(c).alias("q_no")) for i, (r, c) in enumerate(zip(LADDER[1:], ("label", "carry_no", "last_no", "page_no")))])
    c = orphans.select("orphan", "chapter", "field", "value", F.explode(cands).alias("c")).select("orphan", "chapter", "field", "value", "c.*").where("q_no is not null")
    c = c.where((F.col("rule") != "page_position") | (F.col("field") == "solution"))
    r = records.select("chapter", "q_no", "field", F.col("value").alias("have"))
    j = c.join(r, ["chapter", "q_no", "field"])
    same = F.contains(X.norm(F.col("have")), X.norm(F.col("value")))
    j = j.withColumn("outcome", F.when(X.blank("have"), "filled").when(same, "consumed")).where("outcome is not null")
    best = j.groupBy("orphan").agg(F.min_by(F.struct("q_no", "rule", "outcome"), "rank").alias("b"))
    out = orphans.select("orphan").join(best, "orphan", "left")
    return out.select("orphan", F.col("b.q_no").alias("owner"), "b.rule", F.coalesce("b.outcome", F.lit("blocked")).alias("outcome"))


def drop_phantoms(rows: DataFrame, prior: DataFrame, share: float = 0.5) -> DataFrame:
    """Solution-only records whose number an earlier chapter has with a similar solution: the key and score of each."""
    only = rows.where(X.blank("stem") & ~X.blank("solution") & ~F.col("question_pass"))
    j = only.select("chapter", "q_no", "solution").join(prior.select("q_no", F.col("solution").alias("before")), "q_no")
    j = j.withColumn("score", X.overlap(X.tokens(F.col("solution")), X.tokens(F.col("before"))))
    return j.where(F.col("score") >= share).groupBy("chapter", "q_no").agg(F.max("score").alias("score"))


def donate_heads(rows: DataFrame) -> DataFrame:
    """``rows (chapter, q_no, solution)``: a text glued before a record's own header goes to the nearest empty record before it.

    With ``healed``; nothing that holds text is overwritten.
    """
    own = F.regexp_instr(X.text("solution"), F.lit(P.SOLUTION_TO_QUESTION))
    mine = F.regexp_extract(X.text("solution"), P.SOLUTION_TO_QUESTION, 1).try_cast("int") == F.col("q_no")
    glued = (own > 3) & mine
    w = Window.partitionBy("chapter").orderBy("q_no").rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("to", F.when(glued, F.last(F.when(X.blank("solution"), F.col("q_no")), True).over(w))).withColumn("at", own)
    gifts = r.where("to is not null").select("chapter", F.col("to").alias("q_no"), F.col("q_no").alias("giver"), X.strip(F.substring("solution", F.lit(1), F.col("at") - 1)).alias("head"))
    gifts = gifts.groupBy("chapter", "q_no").agg(F.min_by(F.struct("giver", "head"), "giver").alias("g"))
    given = gifts.select("chapter", F.col("g.giver").alias("q_no"), F.lit(True).alias("gave"))
    out = r.join(gifts, ["chapter", "q_no"], "left").join(given, ["chapter", "q_no"], "left")
    tail = F.substring("solution", F.col("at"), F.char_length("solution"))
    healed = F.when(F.col("gave"), tail).when(F.col("g").isNotNull(), F.col("g.head")).otherwise(F.col("solution"))
    return out.withColumn("healed", healed).select(*rows.columns, "healed")
