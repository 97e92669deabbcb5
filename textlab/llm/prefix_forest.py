"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives a vector a long string of random-hyperplane bits; a shard's
index is, per tree, the array of its strings in sorted order.  A query first
descends in every tree to its longest prefix match (binary search beside its
place), then all trees ascend together, one prefix length at a time, until the
strings that share the prefix number at least `reach` times the shard's rows
(over all trees, a vector may be met in several).  All vectors met are scored
exactly.  Every row is indexed; nothing is fitted on the data.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tiles import SHARD_ROWS, best, search, valid_vectors

TREES = 64
BITS = 24
#: Strings to meet, as a multiple of a shard's rows.  Near-random vectors need much; clustered ones stop as soon as their long prefixes give as many.
REACH = 0.6
#: Fewest strings to meet in a shard, so that small shards are searched whole.
LEAST = 2048


def planes(dim: int, trees: int, bits: int, seed: int = 20_011) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, trees * bits))


def codes(m: np.ndarray, plane: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Hash strings as integers, first bit highest: one row per tree."""
    weight = (1 << np.arange(bits - 1, -1, -1)).astype(np.float32)
    out = np.empty((trees, len(m)), np.int64)
    for t in range(trees):
        out[t] = (m @ plane[:, t * bits : (t + 1) * bits] > 0) @ weight
    return out


def spans(sorted_codes: np.ndarray, qc: np.ndarray, length: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per tree and query, the range of the sorted array that shares the first `length` bits."""
    trees = len(sorted_codes)
    shift = bits - length
    lo, hi = np.empty(qc.shape, np.int64), np.empty(qc.shape, np.int64)
    for t in range(trees):
        p = qc[t] >> shift
        lo[t] = np.searchsorted(sorted_codes[t], p << shift)
        hi[t] = np.searchsorted(sorted_codes[t], (p + 1) << shift)
    return lo, hi


def longest(sorted_codes: np.ndarray, qc: np.ndarray, bits: int) -> np.ndarray:
    """Per query the longest prefix that any tree's array shares with it."""
    found = np.zeros(qc.shape[1], np.int64)
    for s, q in zip(sorted_codes, qc, strict=True):
        at = np.searchsorted(s, q)
        for side in (np.clip(at - 1, 0, len(s) - 1), np.clip(at, 0, len(s) - 1)):
            differ = (s[side] ^ q).astype(np.float64)
            found = np.maximum(found, bits - np.where(differ > 0, np.frexp(differ)[1], 0))
    return found


def prefix_forest(
    vectors: DataFrame,
    k: int = 20,
    is_query: Column | None = None,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    trees: int = TREES,
    bits: int = BITS,
    reach: float = REACH,
    least: int = LEAST,
    shard_rows: int = SHARD_ROWS,
    query_rows: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k largest inner products among the vectors met.

    `is_query` is a condition on the column ``id`` (default: id divisible by
    20).  Scores are exact inner products in double precision; ties go to the
    smaller id.  Zero vectors, null ids, null vectors and vectors with null or
    non-finite components take no part; rows equal in id and vector count
    once, different vectors under one id are candidates each, and queries with a
    list each; vectors of different lengths never meet; an empty table gives no
    rows; other columns are ignored.
    """
    rows = valid_vectors(vectors, id_col, vec_col).filter(F.exists("vec", lambda x: x != 0))
    is_query = F.col("id") % 20 == 0 if is_query is None else is_query

    def tile(qi, q, ids, c):
        plane = planes(c.shape[1], trees, bits)
        # inner product by angle: directions are hashed; one more component evens out the candidates' norms
        norms = np.linalg.norm(c, axis=1)
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.square(norms / norms.max())))
        extra = np.random.default_rng(5).standard_normal((1, trees * bits))
        code = codes(np.column_stack([c / norms.max(), rest]), np.vstack([plane, extra]), trees, bits)
        order = np.argsort(code, axis=1, kind="stable")
        inorder = np.take_along_axis(code, order, axis=1)
        order = order.astype(np.int32)
        need = max(least, reach * len(ids))
        for a in range(0, len(qi), 512):
            part = q[a : a + 512]
            qc = codes(part, plane, trees, bits)
            top = longest(inorder, qc, bits)
            low, high = np.zeros(len(part), np.int64), top.copy()
            # counts only grow on the way up, so the stopping length is found by halving
            while np.any(low < high):
                mid = (low + high + 1) // 2
                lo, hi = spans(inorder, qc, mid, bits)
                enough = (hi - lo).sum(axis=0) >= need
                low, high = np.where(enough, mid, low), np.where(enough, high, mid - 1)
            lo, hi = spans(inorder, qc, low, bits)
            for j, i in enumerate(qi[a : a + 512]):
                met = np.zeros(len(ids), bool)
                for t in range(trees):
                    met[order[t, lo[t, j] : hi[t, j]]] = True
                at = np.flatnonzero(met)
                at = at[ids[at] != i]
                if len(at) == 0:
                    continue
                rough = c[at] @ part[j]
                if len(at) > k:
                    edge = np.partition(rough, len(at) - k)[len(at) - k]
                    at = at[rough >= edge - 1e-9 * max(1.0, abs(edge))]
                exact = (c[at] * part[j]).sum(axis=1)
                top_at = best(exact, ids[at], k)
                yield a + j, ids[at][top_at], exact[top_at]

    return search(rows, is_query, k, "double", tile, shard_rows, query_rows)
