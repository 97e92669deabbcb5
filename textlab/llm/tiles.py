"""Tiles of a stated query set against all vectors, and the tree merge of per-tile top lists.

Queries and candidates are dealt by a hash of their row into blocks of a fixed
expected size, so rows that share an id do not share a block; a tile is one block
of queries against one block (shard) of candidates, so a task's memory is bounded
by the block sizes at any input size.  Blocks of queries are sized by bytes, as
every one of them takes a copy of all candidates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut

SHARD_ROWS = 4096
#: Bytes of vectors to a block of queries.
QUERY_BYTES = 32 << 20
FAN_IN = 32


def valid_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec) without null ids, null vectors and vectors with null or non-finite components.

    Rows equal in id and vector count once; different vectors under one id each count.
    """
    bad = F.exists(F.col("vec"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return v.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad).distinct()


def matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten() if isinstance(flat, pa.Array) else pa.chunked_array([c.flatten() for c in flat.chunks]).combine_chunks()
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores, largest first, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    score_type: str,
    tile: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]],
    shard_rows: int = SHARD_ROWS,
    query_rows: int | None = None,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(query_id, rank, vec_id, score) from `vectors` (id, vec).

    `tile(query_ids, queries, ids, candidates)` yields (number of the query, candidate ids, scores), of candidates
    with other ids than the query's.  Query rows that share an id have a list each.  Vectors of different lengths
    never meet.
    """
    rows = cut(vectors.withColumn("dim", F.size("vec")).withColumn("q", F.coalesce(is_query, F.lit(False))))
    rows = rows.withColumn("row", F.monotonically_increasing_id())  # of the rows written out
    n, nq, widest = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.max("dim")).first()
    query_rows = query_rows or max(shard_rows, QUERY_BYTES // (8 * max(1, widest or 1)))
    shards, groups = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(nq / query_rows))
    shard = F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int")
    group = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(groups)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    candidates = rows.select("id", "vec", "dim", "row", F.lit(False).alias("q"), shard.alias("shard"), every(groups).alias("grp"))
    queries = rows.filter("q").select("id", "vec", "dim", "row", "q", group.alias("grp"), every(shards).alias("shard"))
    schema = f"query_id long, query_row long, shard int, vec_id long, score {score_type}"

    def work(key, table):
        dim = key[2].as_py()
        ids, q, row = (table[c].to_numpy() for c in ("id", "q", "row"))
        m = matrix(table["vec"], dim)
        order = np.flatnonzero(~q)
        order = order[np.argsort(ids[order], kind="stable")]
        out = [(qi, c, s) for qi, c, s in tile(ids[q], m[q], ids[order], m[order])] if q.any() and len(order) else []
        counts = [len(c) for _, c, _ in out]
        cat = lambda i, t: np.concatenate([x[i] for x in out]).astype(t) if out else np.zeros(0, t)
        dtype = np.int64 if score_type == "long" else np.float64
        return pa.table({
            "query_id": np.repeat(ids[q][[x[0] for x in out]] if out else np.zeros(0, np.int64), counts),
            "query_row": np.repeat(row[q][[x[0] for x in out]] if out else np.zeros(0, np.int64), counts),
            "shard": np.full(sum(counts), key[0].as_py(), np.int32),
            "vec_id": cat(1, np.int64),
            "score": cat(2, dtype),
        })

    tops = candidates.unionByName(queries).groupBy("shard", "grp", "dim").applyInArrow(work, schema)
    best_first = [F.col("score").desc(), F.col("vec_id")]
    while shards > fan_in:
        tops = tops.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int"))
        tops = tops.withColumn("rank", F.row_number().over(Window.partitionBy("query_row", "shard").orderBy(*best_first)))
        tops = tops.filter(F.col("rank") <= k).drop("rank")
        shards = math.ceil(shards / fan_in)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(*best_first))
    return tops.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
