"""Sources: JSON lines and documents with four tolerances, partition discovery, text layers, model output."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_unparseable"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, which may hold wildcards, leads to anything."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def _schema(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def strict(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines; a malformed line fails the read, a missing path gives no rows."""
    s = _schema(schema)
    return spark.read.schema(s).option("mode", "FAILFAST").json(path) if exists(spark, path) else spark.createDataFrame([], s)


def preserving(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines; a malformed line becomes a row that holds its first 120 characters."""
    s = T.StructType([*_schema(schema).fields, T.StructField(BAD, T.StringType())])
    if not exists(spark, path):
        return spark.createDataFrame([], s)
    out = spark.read.schema(s).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).json(path)
    return out.withColumn(BAD, F.substring(BAD, 1, 120))


def skipping(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines; malformed ones are left out."""
    s = _schema(schema)
    return spark.read.schema(s).option("mode", "DROPMALFORMED").json(path) if exists(spark, path) else spark.createDataFrame([], s)


def document(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One JSON document a file; missing or corrupt files give no row."""
    s = _schema(schema)
    return spark.read.schema(s).option("multiLine", True).option("mode", "DROPMALFORMED").json(path) if exists(spark, path) else spark.createDataFrame([], s)


def partitions(spark: SparkSession, root: str, name: str, schema: str | T.StructType) -> DataFrame:
    """One kind of file below ``root/<subject>/<chapter>/``, with both as columns."""
    out = skipping(spark, f"{root}/*/*/{name}", schema)
    if not exists(spark, f"{root}/*/*/{name}"):
        return out.withColumns({"subject": F.lit(""), "chapter_dir": F.lit("")})
    parts = F.split(F.input_file_name(), "/")
    return out.withColumns({"subject": F.element_at(parts, -3), "chapter_dir": F.element_at(parts, -2)})


def sniff(spark: SparkSession, paths: list[str], *needed: str) -> list[str]:
    """Paths whose first non-blank line names every needed key."""
    out = []
    for p in paths:
        line = spark.read.text(p).where("trim(value) <> ''").limit(1).collect()
        if line and all(f'"{k}"' in line[0][0] for k in needed):
            out.append(p)
    return out


def positioned_lines(words: DataFrame) -> DataFrame:
    """``words (doc, page, x, y, word)`` to lines: words of one rounded baseline from the left, lines from the top."""
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x", "word"))), lambda w: w["word"]), " ")
    return words.groupBy("doc", "page", F.round("y", 1).alias("y")).agg(line.alias("line"))


def with_fallback(pages: DataFrame, ocr) -> DataFrame:
    """``pages (doc, page, text)`` with ``via``: the text layer, or ``ocr(doc, page)`` where it is blank.

    Only pages without text reach the Python branch; a failure gives an empty text.
    """
    blank = F.trim(F.coalesce("text", F.lit(""))) == ""
    schema = T.StructType([*pages.schema.fields, T.StructField("via", T.StringType())])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(doc, page):
            try:
                return ocr(doc, page) or ""
            except Exception:  # noqa: BLE001  any failure of a page is an empty page
                return ""

        for b in batches:
            yield b.assign(text=[one(d, p) for d, p in zip(b["doc"], b["page"])], via="ocr")

    return pages.where(~blank).withColumn("via", F.lit("text")).unionByName(pages.where(blank).mapInPandas(read, schema))


def watermarks(images: DataFrame, pages: int = 5, area: float = 0.5) -> DataFrame:
    """``images (doc, object_id, page, share)``: object ids drawn on many pages over much of them."""
    g = images.groupBy("doc", "object_id").agg(F.count_distinct("page").alias("pages"), F.max("share").alias("share"))
    return g.where((F.col("pages") >= pages) & (F.col("share") >= area)).select("doc", "object_id")


def own_images(images: DataFrame, marks: DataFrame, owned: DataFrame) -> DataFrame:
    """Images that are no watermark and whose bytes nobody owns yet; equal bytes once."""
    return images.join(marks, ["doc", "object_id"], "left_anti").join(owned, "sha", "left_anti").dropDuplicates(["sha"])


def source_changed(files: DataFrame, registry: DataFrame) -> DataFrame:
    """``files (name, content)`` whose hash differs from the registered one while chapters are done."""
    f = files.select("name", F.sha2("content", 256).alias("sha"))
    return f.join(registry.withColumnRenamed("sha", "recorded"), "name").where((F.col("sha") != F.col("recorded")) & (F.col("chapters_done") > 0))


def direct_link(url: Column) -> Column:
    """Share links to direct downloads; others as they are."""
    drive = F.regexp_extract(url, r"drive\.google\.com/(?:file/d/|open\?id=|uc\?.*id=)([A-Za-z0-9_-]+)", 1)
    return F.when(drive != "", F.concat(F.lit("https://drive.google.com/uc?export=download&id="), drive)).otherwise(url)


def fetch_refusal(url: Column, size: Column, head: Column, limit: int = 300 * 1024 * 1024) -> Column:
    """Why a download is refused, or null: scheme, private host, size, not a PDF."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://(?:[^@/]*@)?(\[[^\]]*\]|[^/:?#]*)", 1))
    private = host.rlike(r"^(?:localhost|127\.|10\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2[0-9]|3[01])\.|0\.|\[::1\]|\[f[cd])") | host.endswith(".local") | host.endswith(".internal")
    return F.when(~url.rlike("(?i)^https?://"), "scheme").when(private | (host == ""), "private host").when(size > limit, "too large").when(~head.startswith("%PDF"), "not a PDF")


def model_rows(answer: Column, schema: str) -> Column:
    """Objects of a model's answer: one array, several in a row, or objects line by line, behind prose or a fence; null if anything trails."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(answer, F.lit("")), r"(?s)```[a-z]*", ""), r"(?s)^[^\[{]*", "")
    joined = F.regexp_replace(F.regexp_replace(F.trim(body), r"\]\s*\[", ","), r"\}\s*\n\s*\{", "},{")
    array = F.when(joined.startswith("["), joined).otherwise(F.concat(F.lit("["), joined, F.lit("]")))
    whole = F.regexp_replace(array, r"\s+$", "")
    return F.when(whole.rlike(r"(?s)^\[.*\]$") & (body != ""), F.from_json(whole, f"array<{schema}>", {"mode": "PERMISSIVE"}))


def verdict(answer: Column) -> Column:
    """(flag_genuine, confidence) of the first object of an answer, null unless both are valid."""
    v = F.from_json(F.regexp_extract(F.coalesce(answer, F.lit("")), r"(?s)\{.*\}", 0), "flag_genuine boolean, confidence string")
    return F.when(v["flag_genuine"].isNotNull() & v["confidence"].isin("high", "medium", "low"), v)


def split_control(items: DataFrame, column: str = "item") -> tuple[DataFrame, DataFrame]:
    """(items, control objects): JSON strings with a ``_batch_meta`` or ``_figure_map`` key are control objects."""
    control = F.get_json_object(column, "$._batch_meta").isNotNull() | F.get_json_object(column, "$._figure_map").isNotNull()
    return items.where(~control), items.where(control)
