"""Corpus pipeline over `documents`: each stage works on what the one before kept.

All stages but the last return the columns of `documents`.  Null and empty texts
go through every stage as documents without words; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm.bpe import bpe_encode
from textlab.llm.common import cut, read_table, row_tags
from textlab.llm.jaccard_join import KEYS_BROADCAST, jaccard_join
from textlab.llm.mixing import poisson_mix
from textlab.llm.pii import find_pii
from textlab.llm.quality import quality_scores
from textlab.llm.repeats import DOC, NULL_ID
from textlab.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled documents of the input, does not reject."""
    scored = quality_scores(docs, read_table(spark, sf_dir, "labels"), keep=COLUMNS[1:])
    return scored.filter("predicted = 1").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group whose five-word shingles link at a Jaccard similarity of 0.8 or more.

    A row listed twice stays once.
    """
    key = F.coalesce("doc_id", F.lit(NULL_ID)).alias("d")
    found = jaccard_join(docs, k=5, num=80, den=100)
    counted = found.groupBy(key, "tag", "tag2").agg(F.max("first").alias("stays"), F.count(F.lit(1)).alias("n"))
    # documents that go, and those listed more than once: few of all, as a rule, so that texts need no shuffle
    special = cut(counted.filter("n > 1 or not stays").select(*DOC, "stays"))
    if special.count() <= KEYS_BROADCAST:
        special = F.broadcast(special)
    rows = docs.select(*COLUMNS, key, *row_tags(F.col("text").cast("string")))
    once = rows.join(special, DOC, "left_anti").select(*COLUMNS)
    again = rows.join(special.filter("stays"), DOC, "left_semi")
    again = again.groupBy(*DOC).agg(F.min(F.struct("doc_id", "lang", "source", "n_chars", "text")).alias("row"))
    return once.unionByName(again.select(*(F.col(f"row.{c}").alias(c) for c in COLUMNS)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text, a null text stays null."""
    found = find_pii(docs.withColumn("was_null", F.col("text").isNull()), keep=("lang", "source", "n_chars", "was_null"))
    return found.select(
        "doc_id",
        F.when(~F.col("was_null"), F.col("redacted")).alias("text"),
        "lang",
        "source",
        F.when(F.col("was_null"), F.col("n_chars")).otherwise(F.length("redacted").cast("long")).alias("n_chars"),
    )


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every source to the same share of the characters; a document has a row per copy, in shuffled order."""
    return poisson_mix(docs.select(*COLUMNS), by_row=True).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document that is left, a row per copy."""
    return bpe_encode(docs, ("n_tokens", "ids"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: A fitted classifier and a random field are not expressible in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
