"""Validator flags as rows, one registry of kinds for chapters, sidecars and books: chapter, kind, severity, q_no, detail.

Each function takes the tables its rule needs and gives flag rows; ``union`` puts them together. Details name
what was found, in a fixed order, so a flag's key does not change from run to run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.functions import keys as K
from recordforge.functions import patterns as P
from recordforge.functions import tables as MD
from recordforge.functions import text as X

from . import pairs, records

HIGH, LOW = "HIGH", "LOW"


def flag(df: DataFrame, kind: Column | str, detail: Column, q_no: Column | None = None, severity: str = HIGH) -> DataFrame:
    """Flag rows of ``df (chapter, ...)``."""
    number = F.lit(None) if q_no is None else q_no
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return df.select(F.col("chapter").cast("string").alias("chapter"), kind.alias("kind"), F.lit(severity).alias("severity"), number.cast("long").alias("q_no"), detail.alias("detail"))


def union(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def numbering(rows: DataFrame) -> DataFrame:
    """``rows (chapter, q_no)``: a flag for each run of absent numbers (at its first), and LOW for a chapter that does not begin at 1."""
    gaps, start = records.numbering_gaps(rows), records.numbering_start(rows)
    lost = F.concat(F.lit("absent: "), F.col("from_no").cast("string"), F.lit(".."), F.col("to_no").cast("string"))
    first = F.concat(F.lit("series starts at "), F.col("first_no").cast("string"))
    return union(flag(gaps, "numbering_gap", lost, F.col("from_no")), flag(start, "numbering_start", first, F.col("first_no"), LOW))


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """``rows (chapter, q_no)``: numbers that a chapter has more than once."""
    return flag(records.duplicates(rows, "chapter", "q_no"), "duplicate_id", F.concat(F.col("n").cast("string"), F.lit(" rows")), F.col("q_no"))


def density(rates: DataFrame) -> DataFrame:
    """``rates (chapter, rate)``: chapters whose rate of flags stands out of the book's."""
    return flag(records.density(rates).where("alarm"), "suspect_density", F.lit("missing solutions stand out"))


def drift(rows: DataFrame) -> DataFrame:
    """``rows (chapter, q_no, solution, page)``: numbers with units in a solution that its pages do not have, where they have any."""
    r = rows.withColumn("a", X.unit_numbers(F.col("solution"))).withColumn("b", X.unit_numbers(F.col("page")))
    absent = F.array_sort(F.array_except("a", "b"))
    r = r.where((F.char_length("solution") >= P.DRIFT_MIN_LEN) & (F.size("b") > 0) & (F.size(absent) > 0))
    return flag(r, "numeric_drift_suspect", F.array_join(absent, ","), F.col("q_no"))


def images(refs: DataFrame, disk: DataFrame) -> DataFrame:
    """``refs (chapter, q_no, side, file)`` against ``disk (file, bytes)``: files that are not there, or too small to be figures."""
    j = refs.where(~X.blank("file")).join(disk.groupBy("file").agg(F.max("bytes").alias("bytes")), "file", "left")
    j = j.where(F.col("bytes").isNull() | (F.col("bytes") < P.MIN_IMAGE_BYTES))
    kind = F.when(F.col("bytes").isNull(), "image_ref_missing").otherwise("suspicious_tiny_image")
    return flag(j, kind, F.concat_ws(" ", "side", "file"), F.col("q_no"))


def truncated_tables(tables: DataFrame, solutions: DataFrame) -> DataFrame:
    """``tables (chapter, q_no, markdown)`` with far fewer rows than a sibling of the same header, in solutions that end on a colon."""
    t = tables.select("chapter", "q_no", MD.header_key(F.col("markdown")).alias("h"), MD.body_rows(F.col("markdown")).alias("rows"))
    top = t.groupBy("chapter", "h").agg(F.max("rows").alias("largest"), F.count("*").alias("n")).where("n > 1")
    cut = t.join(top, ["chapter", "h"]).where((F.col("rows") > 0) & (F.col("rows") <= F.col("largest") - P.TABLE_ROW_DEFICIT))
    lead = solutions.where(X.rstrip(X.text("solution")).endswith(":")).select("chapter", "q_no").distinct()
    cut = cut.join(lead, ["chapter", "q_no"], "left_semi")
    return flag(cut, "suspect_truncated_table", F.concat(F.col("rows").cast("string"), F.lit(" of "), F.col("largest").cast("string"), F.lit(" rows: "), F.col("h")), F.col("q_no"))


def sidecar(orphans: DataFrame, unmatched: DataFrame, unresolved: DataFrame, gate: DataFrame) -> DataFrame:
    """What the extractor left beside the records: orphans (chapter), unmatched images (chapter, page, file), unresolved
    images (chapter, page, file, junk), and the gate's figure mismatches (chapter, kind, q_no, detail)."""
    where = lambda c: F.concat(F.lit("page "), F.coalesce(F.col("page").cast("string"), F.lit("?")), F.lit(": "), X.text(c))
    some = lambda df: df.where("chapter is not null")
    return union(
        flag(some(orphans), "orphan_unresolved", F.lit("fragment without a number")),
        flag(some(unmatched), "image_unclaimed", where("file")),
        flag(some(unresolved).where(~F.coalesce("junk", F.lit(False))), "image_unresolved", where("file")),
        flag(some(gate).where("kind = 'figure_page_mismatch'"), "image_owner_gate_miss", X.text("detail"), F.col("q_no")),
    )


def duplicate_texts(rows: DataFrame) -> DataFrame:
    """``rows (chapter, id, stem, payload)``: near-duplicate stems; the suspect is the record whose stem agrees less with its own payload, of equal ones the later."""
    p = pairs.near_duplicates_by_room(rows.select("chapter", "id", F.col("stem").alias("text"))).persist()
    # whole payloads are read of paired records only
    paired = p.select(F.explode(F.array("a", "b")).alias("id")).distinct().persist()
    paired.count()  # pairs are matched once, and where records are few the payloads need not be shuffled to meet them
    own = rows.join(paired, "id", "left_semi").select(pairs.room().alias("room"), "id", X.coherence(F.col("stem"), F.col("payload")).alias("c"))
    own = own.groupBy("room", "id").agg(F.min("c").alias("c")).persist()
    side = lambda k: own.select("room", F.col("id").alias(k), F.col("c").alias(f"c_{k}"))
    j = p.join(side("a"), ["room", "a"]).join(side("b"), ["room", "b"]).withColumn("chapter", F.when(F.col("room") != "", F.substring("room", 2, 2**31 - 1)))
    suspect = F.when(F.col("c_a") < F.col("c_b"), F.col("a")).otherwise(F.col("b"))
    other = F.when(F.col("c_a") < F.col("c_b"), F.col("b")).otherwise(F.col("a"))
    return flag(j, "duplicate_text", F.concat(F.lit("like "), other.cast("string")), suspect)


def foreign_segments(rows: DataFrame) -> DataFrame:
    """``rows (chapter, id, text)``: long passages that a record's text shares with another's; the longer text is the suspect."""
    j = pairs.shared_segments(rows)
    where = rows.select(F.col("id").alias("suspect"), "chapter")
    other = F.when(F.col("suspect") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return flag(j.join(where, "suspect"), "foreign_solution_segment", F.concat(F.lit("shared with "), other.cast("string")), F.col("suspect"))


def neighbor_runs(trusted: DataFrame, known: DataFrame) -> DataFrame:
    """The run of trusted numbers that vouches for a chapter's records: chapter, size, first, last, near_chapter_max.

    trusted: chapter, q_no. known: chapter, q_no, the numbers known before; a run is near if it begins at most 3 after their greatest.
    """
    run = trusted.groupBy("chapter").agg(F.count_distinct("q_no").alias("size"), F.min("q_no").alias("first"), F.max("q_no").alias("last"))
    top = known.groupBy("chapter").agg(F.max("q_no").alias("known_max"))
    near = F.coalesce((F.col("known_max") > 0) & (F.col("first") - F.col("known_max") <= 3), F.lit(False))
    return run.join(top, "chapter", "left").select("chapter", "size", "first", "last", near.alias("near_chapter_max"))


PROVENANCE = ("stem", "options", "answer", "solution")


def provenance(rows: DataFrame) -> DataFrame:
    """``rows`` with ``prov`` (map from field to pass label): field_provenance, without labels of fields that are empty by now, and passes (distinct, sorted)."""
    label = lambda f: F.when(~X.blank(F.col(f).cast("string")), F.try_element_at("prov", F.lit(f)))
    kept = F.map_from_arrays(F.array(*map(F.lit, PROVENANCE)), F.array(*[F.when(~X.blank(label(f)), label(f)) for f in PROVENANCE]))
    passes = F.array_sort(F.array_distinct(F.array_compact(F.map_values("field_provenance"))))
    return rows.withColumn("field_provenance", kept).withColumn("passes", passes)


def anchor_vector(rows: DataFrame) -> DataFrame:
    """``rows`` of ``provenance`` with model_q_no, q_no, pages, anchors (map) to ``anchors_json``: parts that are empty are left out."""
    pages = F.array_sort(F.array_distinct("pages"))
    held = F.map_filter("anchors", lambda k, v: ~X.blank(v))
    vector = F.struct(
        F.coalesce("model_q_no", "q_no").alias("model_q_no"),
        F.col("passes").alias("provenance_notes"),
        F.when(F.size(held) > 0, held).alias("anchors"),
        F.when(F.size(pages) > 0, F.struct(F.lit("page_set").alias("kind"), pages.alias("pages"))).alias("section_position"),
    )
    return rows.withColumn("anchors_json", F.to_json(vector))


def orphan_key(chapter: Column, item: Column, pages: Column) -> Column:
    """Stable identity of a fragment: its chapter, its fields as JSON in the order of the struct, its pages."""
    return F.substring(F.sha1(F.concat_ws("|", X.text(chapter), F.coalesce(F.to_json(item), F.lit("")), F.array_join(pages.cast("array<string>"), ","))), 1, P.KEY_LEN)


def decide(flags: DataFrame, action: str, chapter: str | None = None, kind: str | None = None, severity: str | None = None) -> DataFrame:
    """One decision for each open flag (flag_key, state, content_sig, ...) that the filter shows: flag_key, action, content_sig, q_id. Only approved and ignored can be decided in bulk."""
    if action not in ("approved", "ignored"):
        raise ValueError(f"not a bulk action: {action}")
    out = flags.where("state <> 'closed'")
    for column, value in (("chapter", chapter), ("kind", kind), ("severity", severity)):
        if value:
            out = out.where(F.col(column) == value)
    return out.select("flag_key", F.lit(action).alias("action"), "content_sig", "q_id").distinct()


def context(flags: DataFrame, pages: DataFrame, images: DataFrame, fragments: DataFrame) -> DataFrame:
    """``flags (flag_key, q_id)`` with what a reviewer needs: pages and images of the record, fragments that were found for it.

    pages (q_id, page), images (q_id, file), fragments (q_id, fragment): arrays, sorted, empty where there are none.
    """
    out = flags
    for df, column, name in ((pages, "page", "pages"), (images, "file", "images"), (fragments, "fragment", "fragments")):
        each = df.groupBy("q_id").agg(F.array_sort(F.collect_set(column)).alias(name))
        out = out.join(each, "q_id", "left").withColumn(name, F.coalesce(name, F.array().cast(each.schema[name].dataType)))
    return out


def keyed(flags: DataFrame, source: str = "validation_report") -> DataFrame:
    """Flag rows with the key that decisions use."""
    return flags.withColumn("flag_key", K.flag_key(F.col("kind"), F.concat_ws("-", "chapter", F.col("q_no").cast("string")), F.col("chapter"), F.lit(source), F.col("detail")))
