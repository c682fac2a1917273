"""Field-level operators: views of records, references in free text, gates, patches, edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import patterns as P
from recordforge.functions import text as X
from recordforge.functions.text import blank

# --- fixed values: file names of images ---
IMAGE_NAME = r"[A-Za-z0-9]+/[A-Za-z0-9]+(?:-\d{3})?-p\d+[-A-Za-z0-9@.]*\.webp|[A-Za-z0-9]+/[A-Za-z0-9]+-\d{3}-\d{3}_[A-Z0-9_]+_\d{2}\.webp"
TOC_LINE = r"^\s*(\d{1,3})[.)]?\s+(\S.*?)[\s.]+(\d{1,4})\s*$"
PASSES = {"stem": "Q_PASS", "options": "Q_PASS", "answer": "A_PASS", "solution": "S_PASS"}
SKIPPED = ("_archive/",)


def anchorless() -> Column:
    """No stem, options or solution: nothing ties the record to a page. Given (even empty) options with a stem do."""
    return blank("stem") & blank("solution") & (F.coalesce(F.size("options"), F.lit(0)) <= 0)


def available_passes() -> Column:
    """Map from pass to the field it filled; a later field of a pass takes the entry."""
    each = [F.when(~blank(f), F.struct(F.lit(p).alias("p"), F.lit(f).alias("f"))) for f, p in PASSES.items()]
    have = F.array_compact(F.array(*each))
    last = lambda p: F.element_at(F.filter(have, lambda x: x["p"] == p), -1)["f"]
    names = F.array_distinct(F.transform(have, lambda x: x["p"]))
    return F.map_from_arrays(names, F.transform(names, last))


def orphan_view(orphans: DataFrame) -> DataFrame:
    """orphan, snippet (first non-blank field, 600 characters), pages (sorted, distinct)."""
    first = F.coalesce(*[F.when(~blank(c), F.col(c)) for c in ("stem", "options", "answer", "solution")])
    return orphans.select("orphan", F.substring(first, 1, 600).alias("snippet"), F.array_sort(F.array_distinct("pages")).alias("pages"))


def page_numbers(files: Column) -> Column:
    """Numbers of ``page-012.jpg`` names; others are left out."""
    return F.filter(F.transform(files, lambda f: F.regexp_extract(f, r"-(\d+)\.", 1).try_cast("int")), lambda n: n.isNotNull())


def image_names(detail: Column) -> Column:
    return F.regexp_extract_all(X.text(detail), F.lit(IMAGE_NAME), F.lit(0))


def pick_pages(named: Column, own: Column, most: int = 2) -> Column:
    """The first pages that a detail names, else the record's own."""
    return F.when(F.size(named) > 0, F.slice(named, 1, most)).otherwise(F.slice(F.coalesce(own, F.array().cast("array<int>")), 1, most))


def payload(record: DataFrame) -> DataFrame:
    """What a second opinion sees: fields cut to 700, 200 (each option), 1200 and 400 characters."""
    cut = lambda c, n: F.substring(X.text(c), 1, n)
    options = F.transform("options", lambda o: cut(o, 200))
    return record.withColumns({"stem": cut("stem", 700), "options": options, "solution": cut("solution", 1200), "detail": cut("detail", 400)})


def get_option(letter: str) -> Column:
    return F.get(F.filter("options", lambda o: o["id"] == letter), F.lit(0))["text"]


def set_option(letter: str, value: Column) -> Column:
    return F.transform("options", lambda o: F.when(o["id"] == letter, o.withField("text", value)).otherwise(o))


def option_letters(text: Column) -> Column:
    """Letters of option lines."""
    return F.transform(F.regexp_extract_all(X.text(text), F.lit(r"(?mi)^\s*Option\s+([A-D])\b"), F.lit(1)), F.upper)


def evidence_field() -> Column:
    """The field whose text is evidence for a candidate: solution, stem, options, then answer."""
    return F.coalesce(*[F.when(~blank(c), F.col(c)) for c in ("solution", "stem", "options", "answer")])


def quota_error(message: Column) -> Column:
    """``day`` where a limit of the day is named, else ``burst`` for any other quota error, else null."""
    m = F.lower(X.text(message))
    return F.when(m.rlike(r"per.?day|daily|requestsperday"), "day").when(m.rlike(r"429|quota|rate|exhausted"), "burst")


def repaired_json(s: Column, schema: str) -> Column:
    """JSON, or what single quotes make of it."""
    return F.coalesce(F.from_json(s, schema), F.from_json(F.replace(s, F.lit("'"), F.lit('"')), schema))


def export_gate(records: DataFrame, orphans: DataFrame) -> DataFrame:
    """Violations that keep records from export: q_no, kind. Orphans count only with content."""
    kinds = {"missing_stem": blank("stem"), "missing_answer": blank("answer"), "missing_solution": blank("solution"), "bad_options": F.coalesce(F.size("options"), F.lit(0)) != 4, "broken_asset_ref": F.col("broken") > 0}
    each = F.array_compact(F.array(*[F.when(c, k) for k, c in kinds.items()]))
    lost = orphans.where(~blank("value")).select(F.lit(None).cast("int").alias("q_no"), F.lit("orphan_unresolved").alias("kind"))
    return records.select("q_no", F.explode(each).alias("kind")).unionByName(lost)


def toc_scan(pages: DataFrame, first: int = P.TOC_FIRST, step: int = P.TOC_STEP, cap: int = P.TOC_CAP) -> DataFrame:
    """``pages (book, page, text)``: table-of-contents lines book, page, no, title, start, from a window that grows while it finds more.

    The window ends before the first step without a line, at the cap at the latest.
    """
    w = Window.partitionBy("book").orderBy("batch")
    p = pages.where(F.col("page") <= cap).withColumn("batch", F.greatest(F.lit(0), F.ceil((F.col("page") - first) / step)))
    lines = F.filter(F.split(X.text("text"), "\n"), lambda x: x.rlike(TOC_LINE))
    p = p.withColumn("lines", lines)
    found = p.groupBy("book", "batch").agg(F.sum(F.size("lines")).alias("n"))
    empty = F.min(F.when(F.col("n") == 0, F.col("batch"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    live = found.withColumn("stop", empty).where("stop is null").select("book", "batch")
    rows = p.join(live, ["book", "batch"]).select("book", "page", F.explode("lines").alias("x"))
    part = lambda i: F.regexp_extract("x", TOC_LINE, i)
    return rows.select("book", "page", part(1).cast("int").alias("no"), part(2).alias("title"), part(3).cast("int").alias("start"))


def auto_resolved(flags: DataFrame, owned: DataFrame) -> DataFrame:
    """Image flags (flag_key, detail) whose named files are all owned by now: flag_key. A flag that names none stays."""
    f = flags.select("flag_key", F.explode(image_names(F.col("detail"))).alias("file"))
    j = f.join(owned.select("file", F.lit(True).alias("own")).distinct(), "file", "left")
    return j.groupBy("flag_key").agg(F.bool_and(F.coalesce("own", F.lit(False))).alias("all")).where("all").select("flag_key")


def false_figures(flags: DataFrame, images: DataFrame, least: int = 30_000) -> DataFrame:
    """Figure flags (flag_key, doc, pages) of which no page has a raster that is no watermark and large enough: flag_key."""
    real = images.where(~F.col("watermark") & (F.col("pixels") > least)).select("doc", "page").distinct()
    p = flags.select("flag_key", "doc", F.explode("pages").alias("page")).join(real.withColumn("real", F.lit(True)), ["doc", "page"], "left")
    return p.groupBy("flag_key").agg(F.bool_or(F.coalesce("real", F.lit(False))).alias("any")).where("not any").select("flag_key")


def aliases(names: DataFrame, ledger: DataFrame, refs: DataFrame) -> DataFrame:
    """``names (name)`` to owners: by the name itself or by its final name in the ledger: name, final, q_id."""
    final = names.join(ledger.select(F.col("file").alias("name"), "final_file"), "name", "left").withColumn("final", F.coalesce("final_file", "name"))
    return final.join(refs.withColumnRenamed("file", "final"), "final", "left").select("name", "final", "q_id")


def apply_patches(rows: DataFrame, patches: DataFrame, gate: DataFrame) -> DataFrame:
    """All patches of a chapter or none: chapter, id, value, change.

    rows: chapter, id, value. patches: chapter, id, action (delete, fill, insert), value. gate: chapter, ok. A fill takes only blank
    values (of several fills the least), an insert only ids that are neither there nor deleted; nothing deleted comes back.
    """
    p = patches.join(gate.where("ok"), "chapter").select("chapter", "id", "action", F.col("value").alias("new"))
    gone = p.where("action = 'delete'").select("chapter", "id")
    fill = p.where("action = 'fill'").groupBy("chapter", "id").agg(F.min("new").alias("new"))
    kept = rows.join(gone, ["chapter", "id"], "left_anti").join(fill, ["chapter", "id"], "left")
    use = blank("value") & F.col("new").isNotNull()
    kept = kept.select("chapter", "id", F.when(use, F.col("new")).otherwise(F.col("value")).alias("value"), F.when(use, "filled").otherwise("kept").alias("change"))
    new = p.where("action = 'insert'").join(rows, ["chapter", "id"], "left_anti").join(gone, ["chapter", "id"], "left_anti")
    return kept.unionByName(new.select("chapter", "id", F.col("new").alias("value"), F.lit("inserted").alias("change")))


def carry_owner(candidates: DataFrame) -> DataFrame:
    """``candidates (chapter, kind, q_no, ending_page)``: the one that ended last; of equal ones the question, then the greatest number."""
    best = F.max_by(F.struct("kind", "q_no"), F.struct("ending_page", (F.col("kind") == "question").cast("int"), "q_no"))
    return candidates.groupBy("chapter").agg(best.alias("b")).select("chapter", "b.kind", "b.q_no")


def zip_skipped(path: Column) -> Column:
    """Paths that a live export leaves out."""
    out = path.contains(".bak-") | path.endswith(".zip")
    for s in SKIPPED:
        out = out | path.startswith(s) | path.contains("/" + s)
    return out
