"""Exact and approximate nearest neighbours."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.llm import tiles
from textlab.llm.exact_topk import exact_topk, products
from textlab.llm.prefix_forest import prefix_forest

from .texts import with_clashes


def vectors(spark, n=700, dim=16, seed=0):
    x = np.random.default_rng(seed).standard_normal((n, dim))
    x[n // 2 : n // 2 + 60] = x[n // 2]  # ties
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(n, None), (n + 1, [None] * dim), (n + 2, [math.nan] * dim), (n + 3, [math.inf] * dim), (None, x[0].tolist()), (n + 4, [0.0] * dim)]
    df = spark.createDataFrame(rows + odd + rows[:20], "vec_id long, embedding array<double>")  # rows listed twice
    return x, with_clashes(df).repartition(5)


@pytest.mark.parametrize(("shard", "queries", "fan"), [(4096, 4096, 32), (50, 3, 2)])
def test_exact_topk(spark, monkeypatch, shard, queries, fan):
    monkeypatch.setattr(tiles.search, "__defaults__", (shard, queries, fan))
    x, df = vectors(spark)
    whole = np.floor(1024 * np.vstack([x, np.zeros((1, x.shape[1]))])).astype(int)
    ids = [*range(len(x)), len(x) + 4]
    got = [tuple(r) for r in exact_topk(df, k=10, shard_rows=shard, query_rows=queries).orderBy("query_id", "rank").collect()]
    want = []
    for q in range(0, len(x), 100):
        best = sorted((-int(whole[q] @ v), i) for v, i in zip(whole, ids) if i != q)[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == want


def test_few_candidates_and_none(spark):
    three = spark.createDataFrame([(0, [1.0]), (100, [2.0]), (5, [3.0]), (6, [1.0, 2.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in exact_topk(three).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 5, 3072 * 1024), (0, 2, 100, 2048 * 1024), (100, 1, 5, 3072 * 2048), (100, 2, 0, 2048 * 1024)]
    none = three.filter("vec_id < 0")
    assert exact_topk(none).count() == 0
    assert prefix_forest(none).count() == 0
    assert prefix_forest(three, is_query=F.col("id") == 0).count() == 2


def test_different_vectors_under_one_id(spark):
    rows = [(100, [1.0, 2.0]), (1, [3.0, 4.0]), (1, [5.0, 6.0]), (1, [5.0, 6.0]), (2, [1.0, 1.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in exact_topk(df, scale=1.0).orderBy("query_id", "score").collect()]
    # each of the two query rows has a list of its own, without rows of its own id
    assert sorted((q, i, s) for q, _, i, s in got) == [(100, 1, 4), (100, 1, 6), (100, 1, 11), (100, 1, 17), (100, 2, 1), (100, 2, 3)]
    assert sorted((r, s) for _, r, _, s in got) == [(1, 6), (1, 17), (2, 4), (2, 11), (3, 1), (3, 3)]
    near = [(r["rank"], r["score"]) for r in prefix_forest(df, is_query=F.col("id") == 100).collect()]
    assert sorted(near) == [(1, 6.0), (1, 17.0), (2, 4.0), (2, 11.0), (3, 1.0), (3, 3.0)]


def test_many_rows_under_one_id_spread_over_shards(spark):
    x = np.random.default_rng(3).integers(-9, 9, (600, 4)).astype(float)
    rows = [(7 if i % 3 else 200, v.tolist()) for i, v in enumerate(x)] + [(100, [1.0, 2.0, 3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r["score"] for r in exact_topk(df, scale=1.0, shard_rows=40, is_query=F.col("id") == 100).orderBy("rank").collect()]
    assert got == sorted((int(v @ [1, 2, 3, 4]) for v in np.array([r[1] for r in {(i, tuple(v)) for i, v in rows[:-1]}])), reverse=True)[:10]


def test_products_are_exact():
    rnd = np.random.default_rng(1)
    for size in (10, 2**30, 2**31 - 1):
        a, b = rnd.integers(-size, size, (3, 1)), rnd.integers(-size, size, (4, 1))
        assert products(a.astype(float), b.astype(float)).tolist() == [[int(x[0]) * int(y[0]) for y in b] for x in a]
    with pytest.raises(OverflowError):
        products(np.array([[1e18]]), np.array([[1e18]]))


@pytest.mark.parametrize("shard", [4096, 300])
def test_prefix_forest_recall(spark, shard):
    x, df = vectors(spark, n=3000, dim=32, seed=2)
    got = prefix_forest(df, k=20, shard_rows=shard).collect()
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -9
        truth = set(np.lexsort((np.arange(len(s)), -s))[:20].tolist())
        mine = sorted(found[q])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(m[2] - s[m[1]]) < 1e-12 for m in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len(truth & {m[1] for m in mine})
    assert hits / (150 * 20) >= 0.9


def test_prefix_forest_leaves_out_zero_vectors(spark):
    _, df = vectors(spark)
    assert prefix_forest(df).filter("vec_id >= 700").count() == 0


def test_exact_topk_with_an_empty_vector(spark):
    from textlab.llm.exact_topk import exact_topk

    rows = [(100, [1.0, 2.0]), (1, [3.0, 4.0]), (2, []), (200, [])]
    got = exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), scale=1.0).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(100, 1, 11), (200, 2, 0)]
