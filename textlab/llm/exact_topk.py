"""Exact top-k search: tiled matrix products, partial selection per tile, tree merge of the top lists."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import SHARD_ROWS, best, search, valid_vectors


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole-valued matrices."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q @ c.T).astype(np.int64)
    if most < 2.0**63 and max(np.abs(q).max(), np.abs(c).max()) < 2.0**62:
        return q.astype(np.int64) @ c.astype(np.int64).T
    wide = np.array([[int(x) for x in r] for r in q], dtype=object) @ np.array([[int(x) for x in r] for r in c], dtype=object).T
    if any(abs(int(x)) >= 1 << 63 for x in wide.flat):
        raise OverflowError("an inner product does not fit a long")
    return wide.astype(np.int64)


def exact_topk(
    vectors: DataFrame,
    k: int = 10,
    is_query: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    scale: float = 1024.0,
    shard_rows: int = SHARD_ROWS,
    query_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of floor(scale * x) for each query row.

    `is_query` is a condition on the column ``id`` (default: id divisible by
    100).  Candidates are all rows but the query's own; ties go to the smaller
    id; fewer candidates than k give them all.  Null ids, null vectors and
    vectors with null or non-finite components take no part; rows equal in id
    and vector count once, different vectors under one id are candidates each,
    and queries with a list each; vectors of different lengths never meet; an
    empty table gives no rows; other columns are ignored.
    """
    rows = valid_vectors(vectors, id_col, vec_col)
    is_query = F.col("id") % 100 == 0 if is_query is None else is_query

    def tile(qi, q, ids, c):
        whole_c = np.floor(scale * c)
        for a in range(0, len(qi), 256):
            block = products(np.floor(scale * q[a : a + 256]), whole_c)
            for j, s in enumerate(block, a):
                own = np.searchsorted(ids, qi[j], "right") - np.searchsorted(ids, qi[j])  # ids rise
                at = best(s, ids, k + int(own))
                at = at[ids[at] != qi[j]][:k]
                yield j, ids[at], s[at]

    return search(rows, is_query, k, "long", tile, shard_rows, query_rows)
