"""Writers (K1-K5)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .readers import file_order


def write_lines(df: DataFrame, path: str, value: str, order) -> None:
    """One value per line in ``order`` (K1).

    ``orderBy`` range-partitions the rows, and part files are numbered in
    partition order, so reading the folder's files in name order gives the
    global order.
    """
    out = df.orderBy(*([order] if isinstance(order, str) else order)).select(F.col(value).cast("string"))
    out.write.mode("overwrite").text(path)


def merge_lines(spark: SparkSession, path: str, target: str) -> None:
    """The part files of ``write_lines``, in name order, as one file (K1); bytes are streamed, not held."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    to = jvm.org.apache.hadoop.fs.Path(target)
    out = to.getFileSystem(conf).create(to, True)
    for part in parts:
        source = fs.open(jvm.org.apache.hadoop.fs.Path(part))
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, conf, False)
        source.close()
    out.close()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines written by ``write_lines`` with their file position (``_ord``)."""
    return spark.read.text(path).withColumn("_ord", file_order())


def write_scored(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Scored detail table (K2)."""
    w = df.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Profile / mistake tables, one folder each (K3, K4)."""
    for name, df in tables.items():
        write_scored(df, f"{folder}/{name}", fmt)


def save_model(model, folder: str) -> None:
    """(term, idx, df, idf, coef) parquet + one metadata JSON row (K5)."""
    spark = model.vocab.table.sparkSession
    table = model.vocab.table.join(model.coef, "idx", "left").select(
        "term", "idx", "df", "idf", F.coalesce("coef", F.lit(0.0)).alias("coef")
    )
    table.write.mode("overwrite").parquet(f"{folder}/terms")
    meta = dict(model.meta)
    meta.update({"name": model.name, "bias": model.bias, "threshold": model.threshold,
                 "n_features": model.vocab.size, "n_docs": model.vocab.n_docs})
    spark.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode(
        "overwrite").text(f"{folder}/meta")


def load_model(spark: SparkSession, folder: str):
    """Inverse of ``save_model``; scores are identical to the saved model's."""
    from ..operators.tfidf import Vocabulary
    from ..plans.pipeline import LinearModel

    meta = json.loads(spark.read.text(f"{folder}/meta").first()["value"])
    terms = spark.read.parquet(f"{folder}/terms")
    vocab = Vocabulary(table=terms.select("term", "idx", "df", "idf"), size=int(meta["n_features"]),
                       n_docs=int(meta["n_docs"]))
    return LinearModel(name=meta["name"], vocab=vocab, coef=terms.select("idx", "coef"),
                       bias=float(meta["bias"]), threshold=float(meta["threshold"]), meta=meta)
