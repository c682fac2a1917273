"""Edits and ownership changes that prove themselves, and guards around fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X
from recordforge.functions.text import blank

# --- fixed values: what an edit may name ---
LETTERS, SIDES, OPS = ("A", "B", "C", "D"), ("question", "solution", "option"), ("attach", "detach", "move")


def foreign(fragments: DataFrame, records: DataFrame) -> DataFrame:
    """``fragments (frag, chapter, q_no, text)`` that cannot be their owner's: frag, reason.

    An option label that the owner's options do not explain, a header of another number, or a first line that stands in a
    sibling's solution. records: chapter, q_no, options (map), solution.
    """
    own = fragments.join(records.select("chapter", "q_no", "options"), ["chapter", "q_no"], "left")
    letter = F.upper(F.regexp_extract(X.strip(X.text("text")), P.OPTION_LINE_START, 1))
    text_of = F.coalesce(F.try_element_at("options", letter), F.lit(""))
    words = F.slice(F.filter(X.tokens(text_of), lambda t: F.char_length(t) > 2), 1, 6)
    label = (letter != "") & ~F.exists(words, lambda t: F.contains(X.norm(F.col("text")), t))
    number = F.regexp_extract(X.text("text"), P.SOLUTION_TO_QUESTION, 1).try_cast("int")
    head = X.norm(F.get(X.lines(F.col("text")), F.lit(0)))
    own = own.withColumn("label", label).withColumn("header", F.coalesce(number != F.col("q_no"), F.lit(False))).withColumn("head", head)
    lines = records.select("chapter", F.col("q_no").alias("o"), F.explode(F.array_distinct(F.transform(X.lines(F.col("solution")), X.norm))).alias("head")).where("head <> ''")
    seen = own.select("frag", "chapter", "q_no", "head").join(lines, ["chapter", "head"]).where("o <> q_no").select("frag").distinct().withColumn("sibling", F.lit(True))
    reason = F.when(F.col("label"), "option label").when(F.col("header"), "other header").when(F.col("sibling"), "sibling's line")
    return own.join(seen, "frag", "left").select("frag", reason.alias("reason")).where("reason is not null")


def clip(items: DataFrame, *keep: str) -> DataFrame:
    """``items (response, q_no, solution, and those to keep)``: a solution ends where a header of a sibling of the same response begins; a leading own header goes."""
    at = F.regexp_instr(X.text("solution"), F.lit(P.SOLUTION_TO_QUESTION))
    body = F.when(at.between(1, 3), F.regexp_replace("solution", r"(?i)^\W*Solution\s+to\s+Question\s+\d{1,3}\s*:?\s*", "")).otherwise(F.col("solution"))
    i = items.withColumn("body", F.when(~blank(body), body).otherwise(F.col("solution")))
    cut = F.regexp_instr(X.text("body"), F.lit(P.SOLUTION_TO_QUESTION))
    i = i.withColumn("n", F.regexp_extract(X.text("body"), P.SOLUTION_TO_QUESTION, 1).try_cast("int")).withColumn("cut", cut)
    there = items.select("response", F.col("q_no").alias("n")).distinct().withColumn("there", F.lit(True))
    head = X.strip(F.substring("body", F.lit(1), F.col("cut") - 1))
    out = i.join(there, ["response", "n"], "left")
    return out.select("response", "q_no", *keep, F.when(F.col("there") & (F.col("n") != F.col("q_no")) & (head != ""), head).otherwise(F.col("body")).alias("solution"))


def cross_search(fragments: DataFrame, records: DataFrame, head: int | Column = 120, n: int = 5, gram: int = 4) -> DataFrame:
    """First record (by q_no) whose normalised solution holds a fragment's normalised head: frag, q_no. Blank heads find nothing.

    head: how many characters of the normalised text are its head, a number or a column of fragments. A blank that ends them counts.
    A solution that holds a head holds all its runs of n whole words inside, and all its runs of ``gram`` characters. So
    heads with enough words meet solutions on one run of words, the first that is not cut by either end;
    others on their rarest run of characters, or as a whole if they are shorter than that. Each meets on one key, and the text confirms.
    """
    f = fragments.select("frag", F.substring(X.norm(F.col("text")), F.lit(1), F.lit(head)).alias("head")).where("head <> ''")
    r = records.select("q_no", X.norm(F.col("solution")).alias("body"))
    words = X.tokens(F.col("head"))
    inner = F.slice(words, F.lit(2), F.lit(n))  # the first and last word may be parts of longer ones
    f = f.withColumn("run", F.when(F.size(words) >= n + 2, F.array_join(inner, " "))).persist()
    by_words = f.where("run is not null").select("frag", "head", F.col("run").alias("s"))
    runs = r.select("q_no", F.explode(X.shingles(F.col("body"), n)).alias("s"))
    pairs = by_words.join(runs, "s").select("frag", "head", "q_no")

    def pieces(c: Column, k: Column) -> Column:
        """Distinct runs of k characters (and some cut inside a character of two units, from either side alike)."""
        return F.array_distinct(F.regexp_extract_all(c, F.concat(F.lit("(?s)(?=(.{"), k.cast("string"), F.lit("}))")), F.lit(1)))

    few = f.where("run is null").withColumn("k", F.least(F.lit(gram), F.char_length("head")))
    lengths = sorted(x.k for x in few.select("k").distinct().collect())  # at most ``gram`` numbers; f is then held, and its size known
    if lengths:
        asked = few.select("frag", "head", F.explode(pieces(F.col("head"), F.col("k"))).alias("s"))
        held = r.select("q_no", F.explode(F.flatten(F.array(*[pieces(F.col("body"), F.lit(k)) for k in lengths]))).alias("s"))
        count = held.groupBy("s").agg(F.count("*").alias("c"))
        rarest = asked.join(count, "s", "left").groupBy("frag", "head").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "s")).alias("b")).select("frag", "head", F.col("b.s").alias("s"))
        rarest = rarest.persist()
        rarest.count()  # like that of f: where they are small, the runs of all bodies need not be shuffled to meet them
        pairs = pairs.unionByName(rarest.join(held, "s").select("frag", "head", "q_no"))
    hit = pairs.join(r, "q_no").where(F.contains("body", F.col("head")))
    return hit.groupBy("frag").agg(F.min("q_no").alias("q_no"))


def nearest_empty(rows: DataFrame) -> DataFrame:
    """Each record with the nearest record before it that has no solution: chapter, q_no, empty_before."""
    w = Window.partitionBy("chapter").orderBy("q_no").rowsBetween(Window.unboundedPreceding, -1)
    return rows.select("chapter", "q_no", F.last(F.when(blank("solution"), F.col("q_no")), True).over(w).alias("empty_before"))


def edit_error(field: Column, letter: Column, value: Column) -> Column:
    """Why an edit is refused before any write, or null."""
    table = (field == "table") & MD.table_error(value).isNotNull()
    return F.when(~field.isin("stem", "option", "answer", "solution", "table"), "field").when((field == "option") & ~F.coalesce(letter.isin(*LETTERS), F.lit(False)), "letter").when((field == "answer") & ~value.isin(*LETTERS), "answer").when(table, MD.table_error(value))


def apply_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``rows (id, stem, answer, solution)`` after ``edits (pos, id, field, value)``, the last of a field winning, with verified.

    verified: reading back gives the signature that the edits should make.
    """
    last = edits.groupBy("id", "field").agg(F.max_by("value", "pos").alias("value"))
    new = last.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("e"))
    j = rows.join(new, "id", "left")
    fields = ("stem", "answer", "solution")
    take = lambda f: F.when(F.map_contains_key(F.coalesce("e", F.create_map().cast("map<string,string>")), F.lit(f)), F.try_element_at("e", F.lit(f))).otherwise(F.col(f))
    j = j.withColumn("want", K.signature(*[take(f) for f in fields]))
    out = j.withColumns({f: take(f) for f in fields})
    return out.withColumn("verified", K.signature(*[F.col(f) for f in fields]) == F.col("want")).select("id", *fields, "verified")


def image_op_error(ops: DataFrame, owners: DataFrame) -> DataFrame:
    """``ops (op_id, op, file, chapter, from_id, to_id, to_chapter)``: with error (null: allowed). Shared files, other chapters and missing owners refuse."""
    n = owners.groupBy("file").agg(F.count_distinct("q_id").alias("n"), F.collect_set("q_id").alias("ids"))
    j = ops.join(n, "file", "left")
    error = (
        F.when(~F.col("op").isin(*OPS), "operation")
        .when((F.col("op") != "attach") & F.coalesce(F.col("n") > 1, F.lit(False)), "shared")
        .when((F.col("op") != "attach") & ~F.coalesce(F.array_contains("ids", F.col("from_id")), F.lit(False)), "not the owner")
        .when((F.col("op") == "move") & (F.col("chapter") != F.col("to_chapter")), "other chapter")
    )
    return j.select("op_id", error.alias("error"))


def merge_item(candidates: DataFrame) -> DataFrame:
    """The field that a verified candidate fills, by its flag's kind: id, field, value."""
    field = (
        F.when(F.col("kind").isin("empty_question", "contaminated_question", "suspect_stem"), "stem")
        .when(F.col("kind").isin("missing_answer", "answer_mismatch"), "answer")
        .when(F.col("kind").isin("missing_solution", "truncated_solution", "short_bare_solution"), "solution")
        .when(F.col("kind").isin("bad_options", "blank_correct_option"), "options")
    )
    return candidates.select("id", field.alias("field"), F.when(field.isNotNull(), F.col("value")).alias("value"))


def to_html(md: Column) -> Column:
    """A markdown table as escaped HTML."""
    esc = lambda x: F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    rows = F.filter(MD.table_lines(md), lambda x: ~MD.separator(x))
    cells = lambda x: F.transform(F.split(F.regexp_replace(x, r"^\||\|$", ""), r"(?<!\\)\|"), lambda c: esc(X.strip(c)))
    row = lambda x, i: F.concat(F.lit("<tr>"), F.array_join(F.transform(cells(x), lambda c: F.when(i == 0, F.concat(F.lit("<th>"), c, F.lit("</th>"))).otherwise(F.concat(F.lit("<td>"), c, F.lit("</td>")))), ""), F.lit("</tr>"))
    return F.concat(F.lit("<table>"), F.array_join(F.transform(rows, row), ""), F.lit("</table>"))


def image_cap(side: Column, declared: Column) -> Column:
    """Images that an owner may keep: the soft cap, raised to what was declared, never above the ceiling."""
    soft, top = F.when(side == "question", P.SOFT_CAP_QUESTION).otherwise(P.SOFT_CAP_SOLUTION), F.when(side == "question", P.CEILING_QUESTION).otherwise(P.CEILING_SOLUTION)
    return F.least(top, F.greatest(soft, F.coalesce(declared, F.lit(0))))
