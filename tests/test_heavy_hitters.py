"""Most repeated texts by summaries with an error bound, against a count of everything."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlab.operators import profile
from textlab.operators.profile import frequent_keys, top_repeated_texts


def zipf(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice([0, 1, None]), f"text {min(int(rnd.paretovariate(0.7)), 5000)}") for _ in range(n)]


def frame(spark, rows, parts=6):
    return spark.createDataFrame(rows, "binary_label int, text string").repartition(parts)


def want(rows, k):
    order = lambda c: (-c[1], (c[0][0] is not None, c[0][0] or 0), c[0][1] is not None, c[0][1] or "")  # noqa: E731  nulls first, as Spark sorts
    return [(label, text, n) for (label, text), n in sorted(Counter(rows).items(), key=order)[:k]]


@pytest.mark.parametrize(("kept", "held"), [(4096, 1 << 18), (30, 60), (8, 400), (2, 3)])
def test_equal_to_a_full_count(spark, kept, held):
    for seed, k in ((1, 20), (2, 5)):
        rows = zipf(seed, 3000) + [(0, None)] * 40
        got = [tuple(r) for r in top_repeated_texts(frame(spark, rows), k, kept=kept, held=held).collect()]
        assert got == want(rows, k)


def test_the_bound_holds(spark):
    rows = zipf(3, 4000)
    df = frame(spark, rows).select(F.xxhash64("binary_label", "text").alias("h1"), F.lit(5).cast("long").alias("h2"))
    true = {r["h1"]: r["n"] for r in df.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).collect()}
    for kept, held in ((5, 20), (50, 80), (10**6, 10**6)):
        told, bound = frequent_keys(df, kept, held)
        told = {r["h1"]: r["frequency"] for r in told.collect()}
        assert all(told.get(h, 0) <= n <= told.get(h, 0) + bound for h, n in true.items())
        assert len(told) <= kept * 6
    assert bound == 0 and told == true


def test_only_candidates_meet(spark, monkeypatch):
    """Heavy texts among very many single ones: no table of groups is built."""
    rows = [(0, f"single {i}") for i in range(20_000)] + [(1, f"heavy {i}") for i in range(30) for _ in range(200 + i)]
    monkeypatch.setattr(profile, "_top_by_groups", None)
    got = [tuple(r) for r in top_repeated_texts(frame(spark, rows), 20, kept=64, held=512).collect()]
    assert got == want(rows, 20)


def test_texts_that_hardly_repeat(spark):
    rows = [(i % 2, f"only {i}") for i in range(3000)] + [(0, "only 0"), (1, "x"), (1, "x")]
    got = [tuple(r) for r in top_repeated_texts(frame(spark, rows), 10, kept=16, held=64).collect()]
    assert got == want(rows, 10)
    assert top_repeated_texts(frame(spark, rows).limit(0)).count() == 0
    few = [(0, "a"), (1, "b"), (1, "b")]
    assert [tuple(r) for r in top_repeated_texts(frame(spark, few)).collect()] == want(few, 20)
