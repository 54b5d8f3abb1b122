"""From raw documents to packed sequences: language, exact copies, near copies, personal data, packing."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smeltworks.llm import language_id, pii
from smeltworks.llm.exact_dedup import exact_dedup
from smeltworks.llm.packing import packed_digests
from smeltworks.llm.simhash import simhash_dedup
from smeltworks.sources.scratch import materialise

ROW = "_corpus_row"


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language stay, and ``lang`` becomes the predicted one; those without a letter go.

    The model learns from the labelled rows of ``docs`` itself. Without any labelled row nothing can be told, and nothing goes.
    Ids take no part: rows without one, or with a repeated one, are treated like all others.
    """
    counts = language_id.train(docs)
    if not counts:
        return docs
    found = language_id.identify(docs, counts, names=("_predicted", "_share")).where(F.col("_predicted") != "und")
    return found.withColumn("lang", F.col("_predicted")).select(*docs.columns)


def _one_of_each(docs: DataFrame, groups: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``docs`` without all but one row of each group: the smallest id stays, of rows that repeat it, or have none, one.

    Rows are told apart by a number of their own, written with them. ``groups`` takes the numbered rows and returns
    ``(ROW, _group)``; only these numbers travel to find what goes.
    """
    rows = materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    named = groups(rows).join(rows.select(ROW, F.col("doc_id").alias("_id")), ROW)
    named = materialise(named.select("_group", F.struct(F.col("_id").isNull().alias("nameless"), "_id", ROW).alias("_member")), "named")
    first = named.groupBy("_group").agg(F.min("_member").alias("_first"))
    dropped = named.join(first, "_group").where("_member <> _first").select(F.col("_member")[ROW].alias(ROW))
    return rows.join(materialise(dropped, "dropped"), ROW, "left_anti").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the smallest id."""

    def groups(rows: DataFrame) -> DataFrame:
        return exact_dedup(rows, doc_id=ROW).select(F.col("doc_id").alias(ROW), F.col("keep_id").alias("_group"))

    return _one_of_each(docs, groups)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints stays, the one with the smallest id."""

    def groups(rows: DataFrame) -> DataFrame:
        return simhash_dedup(rows, doc_id=ROW).select(F.col("doc_id").alias(ROW), F.col("component_id").alias("_group"))

    return _one_of_each(docs, groups)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; personal data in its text gives way to the kind in brackets, and ``n_chars`` follows."""
    clean = pii.redact(docs, pii.train(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences. A row without an id is packed like others, its pieces have a null id."""
    return packed_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", languages),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL cannot express the stages; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
