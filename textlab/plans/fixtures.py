"""Inputs derived from the driver's tables (see FIXTURES.md section 3).

The reference's own files (corpus TSV, split CSVs, test TSV) are not
available, so their raw strings are derived from ``documents`` and
``labels`` with SQL expressions that Spark and DuckDB evaluate identically.
The expressions below are the single source for both engines: Spark uses
them through ``F.expr``, the oracle SQL embeds the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text

# ---------------------------------------------------------------------------
# Fixture expressions shared with the DuckDB oracle
# ---------------------------------------------------------------------------
SPLIT = "case when doc_id % 10 < 8 then 'train' when doc_id % 10 = 8 then 'dev' else 'test' end"
RAW_LABEL = "2 * toxic + (1 - quality) + doc_id % 2"
LABEL_VECTOR = (
    "'[' || concat_ws(', ', "
    + ", ".join(
        f"case when toxic = 1 and (doc_id + {i}) % 3 = 0 then '1' else '0' end" for i in range(7)
    )
    + ") || ']'"
)
LABEL_RAW = (
    "case when doc_id % 8 < 4 then " + LABEL_VECTOR
    + " when doc_id % 8 = 4 then cast(toxic as string)"
    + " when doc_id % 8 = 5 then '2'"
    + " when doc_id % 8 = 6 then '[1, 0'"
    + " else null end"
)
RECORD_ID_RAW = "case when doc_id % 13 = 5 then 'x' || doc_id else cast(doc_id as string) end"
ARTICLE_ID_RAW = (
    "case when doc_id % 11 = 4 then cast(doc_id * 7 as string) else '@@' || cast(doc_id * 7 as string) end"
)
SAMPLE_ID_RAW = "case when doc_id % 17 = 3 then 'q_' || doc_id else 't_' || doc_id end"
RAW_LABEL_RAW = (
    "case doc_id % 9 when 0 then 'n/a' when 1 then '7' when 2 then '1.5' "
    "else cast(" + RAW_LABEL + " as string) end"
)
KEYWORD_RAW = "case when doc_id % 19 = 0 then null else source end"
COUNTRY_RAW = "case when doc_id % 23 = 0 then 'NA' else lang end"
# Exact fixture score (integer numerator, double division in both engines).
SCORE_K = "(doc_id * 7919) % 1000 + 300 * toxic"
SCORE = f"cast({SCORE_K} as double) / cast(1300 as double)"
Y_PRED = f"cast({SCORE_K} >= 650 as int)"
LOGIT_1 = f"cast({SCORE_K} as double) / cast(325 as double) - cast(2 as double)"
LOGIT_0 = f"-({LOGIT_1}) / cast(2 as double)"
# Second copies of split rows (keep-last dedupe): every 5th id, label flipped.
DUP_FILTER = "doc_id % 5 = 0"
DUP_ORD_OFFSET = 1_000_000_000_000


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


# ---------------------------------------------------------------------------
# Raw strings for the ingestion operators
# ---------------------------------------------------------------------------
def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents (+ labels for the severity) as raw corpus strings, file order = doc_id."""
    documents, labels = tables(spark, sf_dir, "documents", "labels")
    d = documents.join(labels, "doc_id", "left")
    return d.select(
        "doc_id",
        F.expr(RECORD_ID_RAW).alias("record_id"),
        F.expr(ARTICLE_ID_RAW).alias("article_id"),
        F.expr(KEYWORD_RAW).alias("keyword"),
        F.expr(COUNTRY_RAW).alias("country"),
        F.col("text"),
        F.expr(RAW_LABEL_RAW).alias("raw_label"),
        F.struct(F.col("doc_id")).alias("_ord"),
    )


def raw_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw test strings (5 fields)."""
    (documents,) = tables(spark, sf_dir, "documents")
    return documents.select(
        "doc_id",
        F.expr(SAMPLE_ID_RAW).alias("sample_id"),
        F.expr(ARTICLE_ID_RAW).alias("article_id"),
        F.expr(KEYWORD_RAW).alias("keyword"),
        F.expr(COUNTRY_RAW).alias("country"),
        F.col("text"),
        F.struct(F.col("doc_id")).alias("_ord"),
    )


def raw_split(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    """labels as raw split rows (par_id, label); every 5th id repeated later, flipped."""
    (labels,) = tables(spark, sf_dir, "labels")
    first = labels.select(
        F.col("doc_id").cast("string").alias("par_id"), F.expr(LABEL_RAW).alias("label"),
        F.struct(F.col("doc_id").alias("pos")).alias("_ord"),
    )
    if not with_duplicates:
        return first
    second = labels.filter(DUP_FILTER).select(
        F.col("doc_id").cast("string").alias("par_id"),
        F.expr("cast(1 - toxic as string)").alias("label"),
        F.struct((F.col("doc_id") + F.lit(DUP_ORD_OFFSET)).alias("pos")).alias("_ord"),
    )
    return first.unionByName(second)


# ---------------------------------------------------------------------------
# Clean modelling tables (the data-model mapping)
# ---------------------------------------------------------------------------
def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as the parsed corpus: record_id, article_id, keyword, country, text."""
    (documents,) = tables(spark, sf_dir, "documents")
    return documents.select(
        F.col("doc_id").alias("record_id"),
        (F.col("doc_id") * 7).alias("article_id"),
        F.col("source").alias("keyword"),
        F.col("lang").alias("country"),
        clean_text("text").alias("text"),
    )


def split_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels as the split table: record_id, binary_label, label_raw, split."""
    (labels,) = tables(spark, sf_dir, "labels")
    return labels.select(
        F.col("doc_id").alias("record_id"),
        F.col("toxic").cast("int").alias("binary_label"),
        F.expr(LABEL_RAW).alias("label_raw"),
        F.expr(SPLIT).alias("split"),
    )


def test_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled test split: every document with doc_id % 10 = 9."""
    (documents,) = tables(spark, sf_dir, "documents")
    return documents.filter("doc_id % 10 = 9").select(
        F.col("doc_id").alias("record_id"),
        (F.col("doc_id") * 7).alias("article_id"),
        F.col("source").alias("keyword"),
        F.col("lang").alias("country"),
        clean_text("text").alias("text"),
    )


def scored_fixture(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """All labelled rows with the exact fixture score, prediction and logits."""
    (labels,) = tables(spark, sf_dir, "labels")
    df = labels.select(
        F.col("doc_id").alias("record_id"),
        F.col("toxic").cast("int").alias("y_true"),
        F.expr(SCORE).alias("score"),
        F.expr(Y_PRED).alias("y_pred"),
        F.expr(LOGIT_0).alias("l0"),
        F.expr(LOGIT_1).alias("l1"),
        F.expr(LABEL_RAW).alias("label_raw"),
        F.expr(SPLIT).alias("split"),
    )
    if with_text:
        (documents,) = tables(spark, sf_dir, "documents")
        docs = documents.select(F.col("doc_id").alias("record_id"), clean_text("text").alias("text"))
        df = df.join(docs, "record_id", "left")
    return df
