"""The conflict-aware keyed merge, relinking, option ownership and slices: operators whose order matters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordforge.functions import text as X
from recordforge.functions.text import blank

FIELDS = ("stem", "answer", "solution")


def scope(items: DataFrame) -> DataFrame:
    """Null the fields that an item's pass does not own: Q stem and options, A answer, S solution and answer."""
    own = {"stem": ["Q"], "options": ["Q"], "answer": ["A", "S"], "solution": ["S"]}
    return items.withColumns({f: F.when(F.col("pass").isin(p), F.col(f)) for f, p in own.items() if f in items.columns})


def merge(items: DataFrame, known: DataFrame | None = None, fill_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """Merge ``items (chapter, q_no, seq, pass, stem, answer, solution)`` by chapter and number: (records, skipped).

    Only the Q pass sets a stem; a contaminated stem fills nothing. Of several valid stems the one that agrees best with the
    record's solutions wins, the first of equal ones. The first answer stays; another one is a conflict. The last solution
    wins; with ``fill_only`` the first does, unless a later one contains it and more. Items without a number, or of
    numbers that ``known (chapter, q_no)`` lacks, are skipped with a reason.
    """
    keyed = items.where("q_no is not null")
    skipped = items.where("q_no is null").withColumn("reason", F.lit("no number"))
    if known is not None:
        ks = known.select("chapter", "q_no").distinct()
        skipped = skipped.unionByName(keyed.join(ks, ["chapter", "q_no"], "left_anti").select(*items.columns).withColumn("reason", F.lit("foreign number")))
        keyed = keyed.join(ks, ["chapter", "q_no"], "left_semi")
    keyed = scope(keyed)
    whole = keyed.groupBy("chapter", "q_no").agg(
        F.array_sort(F.collect_list(F.when(~blank("stem"), F.struct("seq", "stem")))).alias("stems"),
        F.min_by("answer", F.when(~blank("answer"), F.col("seq"))).alias("answer"),
        F.size(F.collect_set(F.when(~blank("answer"), F.col("answer")))).alias("answers"),
        F.array_sort(F.collect_list(F.when(~blank("solution"), F.struct("seq", "solution")))).alias("solutions"),
    )

    def longer(acc: Column, x: Column) -> Column:
        more = (F.char_length(x["solution"]) > F.char_length(acc)) & F.contains(X.norm(x["solution"]), X.norm(acc))
        return F.when((acc == "") | more, x["solution"]).otherwise(acc)

    solution = F.aggregate("solutions", F.lit(""), longer) if fill_only else F.coalesce(F.get("solutions", F.size("solutions") - 1)["solution"], F.lit(""))
    whole = whole.withColumn("solution", F.nullif(solution, F.lit("")))
    valid = F.filter("stems", lambda s: X.contamination(s["stem"], F.col("solution")).isNull())
    scored = F.transform(valid, lambda s: F.struct((-X.coherence(s["stem"], F.coalesce("solution", F.lit("")))).alias("c"), s["seq"].alias("seq"), s["stem"].alias("stem")))
    best = F.get(F.array_sort(scored), F.lit(0))["stem"] if not fill_only else F.get(valid, F.lit(0))["stem"]
    conflicts = (F.size(F.array_distinct(F.transform("stems", lambda s: X.norm(s["stem"])))) > 1).cast("int") + (F.col("answers") > 1).cast("int")
    return whole.select("chapter", "q_no", best.alias("stem"), "answer", "solution", conflicts.alias("conflicts")), skipped


def relink(claims: DataFrame, records: DataFrame, files: DataFrame, linked: DataFrame) -> DataFrame:
    """Ledger claims to attach again: chapter, q_no, file. Claimed or shared, of a record that still exists, with its file on disk, not linked yet."""
    ok = claims.where(F.col("outcome").isin("claimed", "shared")).select("chapter", "q_no", "file").distinct()
    return ok.join(records, ["chapter", "q_no"], "left_semi").join(files, "file", "left_semi").join(linked, ["chapter", "q_no", "file"], "left_anti")


def option_owner(figures: DataFrame, labels: DataFrame, margin: float = 20.0) -> DataFrame:
    """``figures (page, fig, x, y)`` under ``labels (page, letter, x, y)``: page, fig, letter (null: question level).

    The candidates are the labels of the closest row above (y grows upwards); the nearest by x wins only by a clear margin.
    """
    j = figures.join(labels.select("page", "letter", F.col("x").alias("lx"), F.col("y").alias("ly")), "page").where("ly > y")
    w = Window.partitionBy("page", "fig")
    j = j.withColumn("row", F.min("ly").over(w)).where("abs(ly - row) <= 1")
    d = F.array_sort(F.collect_list(F.struct(F.abs(F.col("lx") - F.col("x")).alias("d"), "letter")))
    g = j.groupBy("page", "fig").agg(d.alias("d"))
    clear = (F.size("d") == 1) | (F.get("d", F.lit(1))["d"] - F.get("d", F.lit(0))["d"] >= margin)
    g = g.select("page", "fig", F.when(clear, F.get("d", F.lit(0))["letter"]).alias("letter"))
    return figures.select("page", "fig").join(g, ["page", "fig"], "left")


def slice_groups(rects: DataFrame, gap: float = 4.0, backdrop: float = 0.8) -> DataFrame:
    """``rects (page, id, x, y, w, h, share)``: groups of abutting rectangles of a page: page, id, lead (topmost of its group).

    Rectangles that cover most of a page stand alone. A page holds few rectangles, so a page is one group of rows.
    """

    def unite(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.sort_values("id").to_dict("records")
        up = list(range(len(r)))

        def find(i: int) -> int:
            while up[i] != i:
                i = up[i]
            return i

        for i, a in enumerate(r):
            for j in range(i):
                b = r[j]
                if max(a["share"], b["share"]) >= backdrop:
                    continue
                dx = max(a["x"], b["x"]) - min(a["x"] + a["w"], b["x"] + b["w"])
                dy = max(a["y"], b["y"]) - min(a["y"] + a["h"], b["y"] + b["h"])
                if max(dx, dy) <= gap and min(dx, dy) < 0:
                    up[find(i)] = find(j)
        lead: dict[int, tuple] = {}
        for i, a in enumerate(r):
            lead[find(i)] = max(lead.get(find(i), (float("-inf"), 0)), (a["y"] + a["h"], -a["id"]))
        return pd.DataFrame({"page": [a["page"] for a in r], "id": [a["id"] for a in r], "lead": [-lead[find(i)][1] for i in range(len(r))]})

    return rects.groupBy("page").applyInPandas(unite, "page int, id int, lead int")


def harvested_options(records: DataFrame) -> DataFrame:
    """``records (chapter, q_no, options map, solution)`` whose options came off a solution page: chapter, q_no, commentary, corroborated.

    Two commentary-shaped options, or one option that stands verbatim in another record's solution.
    """
    o = records.select("chapter", "q_no", F.explode("options").alias("k", "t")).where(F.char_length(X.strip(X.text("t"))) > 1)
    o = o.withColumn("commentary", X.text("t").rlike(r"(?i)^\s*(?:it is|this is|option [a-d]\b|because|incorrect|correct)"))
    other = records.select("chapter", F.col("q_no").alias("o_no"), F.explode(F.array_distinct(F.split(X.norm(F.col("solution")), r"(?<=[.!?]) "))).alias("line"))
    line = lambda c: F.regexp_replace(c, r"[.!?]+$", "")
    hit = o.withColumn("line", line(X.norm(F.col("t")))).join(other.withColumn("line", line(F.col("line"))), ["chapter", "line"]).where("q_no <> o_no")
    hit = hit.groupBy("chapter", "q_no").agg(F.count_distinct("k").alias("corroborated"))
    c = o.groupBy("chapter", "q_no").agg(F.count_if("commentary").alias("commentary"))
    out = c.join(hit, ["chapter", "q_no"], "left").select("chapter", "q_no", "commentary", F.coalesce("corroborated", F.lit(0)).alias("corroborated"))
    return out.where("commentary >= 2 or corroborated >= 1")


def qa_status(records: DataFrame) -> DataFrame:
    """READY, REVIEW_NEEDED or INCOMPLETE with reasons: never corrected, only said.

    records: stem, options (int, non-blank), answer, solution, model_only_image, gate_notice, answer_flip (booleans).
    """
    hard = {"missing_stem": blank("stem"), "bad_options": F.col("options") != 4, "missing_answer": blank("answer"), "missing_solution": blank("solution")}
    soft = {"model_only_image": F.col("model_only_image"), "gate_notice": F.col("gate_notice"), "answer_flip": F.col("answer_flip")}
    pick = lambda m: F.array_compact(F.array(*[F.when(c, k) for k, c in m.items()]))
    a, b = pick(hard), pick(soft)
    status = F.when(F.size(a) > 0, "INCOMPLETE").when(F.size(b) > 0, "REVIEW_NEEDED").otherwise("READY")
    return records.withColumn("qa_status", status).withColumn("qa_reasons", F.array_join(F.concat(a, b), ","))


def owner_contest(fragments: DataFrame, records: DataFrame, least: int = 6, margin: float = 0.15) -> DataFrame:
    """``fragments (frag, chapter, q_no, text)`` placed by position against ``records (chapter, q_no, text, whole)``: frag, verdict, better.

    Another record of the chapter that agrees clearly better vetoes the place, or takes the fragment if its own text is not
    whole. Fragments of few words carry no evidence.
    """
    f = fragments.withColumn("w", X.tokens(F.col("text")))
    r = records.select("chapter", F.col("q_no").alias("r_no"), X.tokens(F.col("text")).alias("rw"), "whole")
    s = f.join(r, "chapter").withColumn("s", X.overlap(F.col("w"), F.col("rw")))
    g = s.groupBy("frag", F.size("w").alias("n")).agg(
        F.max(F.when(F.col("r_no") == F.col("q_no"), F.col("s"))).alias("own"), F.max(F.when(F.col("r_no") != F.col("q_no"), F.struct("s", "r_no", "whole"))).alias("b")
    )
    lost = (F.col("n") >= least) & (F.col("b.s") >= F.coalesce("own", F.lit(0.0)) + margin)
    verdict = F.when(F.coalesce(lost, F.lit(False)), F.when(F.col("b.whole"), "veto").otherwise("redirect")).otherwise("ok")
    return g.select("frag", verdict.alias("verdict"), F.when(verdict != "ok", F.col("b.r_no")).alias("better"))
