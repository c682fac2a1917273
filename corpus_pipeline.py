"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row of ``docs`` and returns a DataFrame
that is written as Parquet before the next stage reads it. All but the last return the columns of
``documents``. Null ids, repeated rows and empty tables pass through as each operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordforge.llm import common, language, mixing, pii, sentencepieces, simhash

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document is rejected if no language reaches this share of its positions.
LEAST_SCORE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a language, and name it in ``lang``; texts without letters go."""
    docs = docs.select(*COLUMNS)
    net = language.train(docs)
    out = language.identify(docs, net).where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return out.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (similarity of five-word shingles 0.8 or more): the smallest doc_id.

    Wide SimHashes meet in tries; links are confirmed by the whole shingle sets.
    """
    return simhash.first_of_groups(docs.select(*COLUMNS), words=5)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; n_chars counts the new text's code points."""
    return pii.redact(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources come near their target weights."""
    return mixing.mixed(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with whether they decode to its text."""
    return sentencepieces.encode(docs.select(*COLUMNS), sentencepieces.load(sentencepieces.default_path()), check=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", tokenize),
]

#: No stage before the last can be said in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = common.table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
