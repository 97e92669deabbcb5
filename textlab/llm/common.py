"""Helpers shared by the training-data operators: reading, materialising, Arrow buffers, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.session import checkpoint_root, scratch_path

#: Bytes of text that one numpy step handles at a time; whole documents only.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder; Spark's cleaner owns the files."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def stash(df: DataFrame, name: str) -> DataFrame:
    """Materialise as a Parquet table in the shared checkpoint folder (packs numbers better than a checkpoint)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_tags(text: Column) -> tuple[Column, Column]:
    """(tag, tag2): 127 bits of two hashes of the text; with doc_id they tell rows apart whose doc_id is null or repeated."""
    text = F.coalesce(text, F.lit(""))
    first = F.xxhash64(text)
    tag = F.shiftleft(first.bitwiseAND(F.lit((1 << 31) - 1)), 32).bitwiseOR(F.shiftrightunsigned(first, 32))
    return tag.alias("tag"), F.xxhash64(F.lit(1), text).alias("tag2")


def keyed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tag, tag2, text): null text is empty; rows equal in id and text are one document listed twice."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), *row_tags(text), text.alias("text"))


def same_doc(a: DataFrame, b: DataFrame) -> Column:
    """Join condition on the document key; a null doc_id equals a null doc_id."""
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tag"] == b["tag"]) & (a["tag2"] == b["tag2"])


def strings(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive whole documents of about `limit` bytes."""
    buf, off = strings(column)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
        b = min(b, n, a + 30_000)
        yield a, b, buf[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): connected components of an edge table; comp is the smallest node.

    Min-label propagation with pointer jumping.  Each round is two keyed
    aggregations that combine map-side, so a star with very many leaves does
    not gather in one task, and the number of rounds grows with the logarithm
    of the longest path.  Only a count of changed labels reaches the driver.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = cut(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("comp")))
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy(F.col("u").alias("node")).agg(F.min("comp").alias("c"))
        hooked = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "c").alias("comp"))
        up = hooked.select(F.col("node").alias("p"), F.col("comp").alias("pc"))
        jumped = hooked.join(up, hooked["comp"] == up["p"], "left").select(
            "node", "old", F.least("comp", F.coalesce("pc", "comp")).alias("comp")
        )
        jumped = cut(jumped)
        labels = jumped.select("node", "comp")
        if jumped.filter("old <> comp").isEmpty():
            return labels
