"""Exact quantiles by counted ranges, against Spark's own percentile."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textlab.operators.profile import exact_quantiles, token_quantile, token_stats


def rows(seed, n):
    rnd = random.Random(seed)
    draw = {
        "even": lambda: rnd.random(),
        "ties": lambda: float(rnd.choice([1, 2, 2, 2, 5])),
        "wide": lambda: rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300),
        "both": lambda: 3.5 if rnd.random() < 0.6 else rnd.gauss(3.5, 1e-9),
        "one": lambda: 7.25,
    }
    out = [(g, f()) for g, f in draw.items() for _ in range(n)]
    return out + [("none", None), ("few", 2.0), ("few", 3.0), ("few", None), (None, 1.0), (None, 4.0)]


@pytest.mark.parametrize("pick", [5, 100, 10**6])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_equal_to_percentile(spark, q, pick):
    df = spark.createDataFrame(rows(int(q * 100), 1500), "g string, x double").repartition(3)
    want = dict(df.groupBy("g").agg(F.percentile("x", q)).collect())
    got = dict(exact_quantiles(df, "x", q, "g", accuracy=50, pick_max=pick).collect())
    assert got.keys() == want.keys()
    for g, v in want.items():
        assert got[g] == v or got[g] == pytest.approx(v, rel=1e-15), g


def test_nan_is_the_largest_value(spark):
    df = spark.createDataFrame([(float(i),) for i in range(40)] + [(math.nan,)] * 11, "x double")
    for q, pick in ((0.5, 3), (0.7, 3), (0.9, 3), (0.9, 100)):
        want, got = df.agg(F.percentile("x", q)).first()[0], exact_quantiles(df, "x", q, accuracy=20, pick_max=pick).first()[0]
        assert got == want or (math.isnan(got) and math.isnan(want))


def test_many_groups(spark):
    rnd = random.Random(4)
    df = spark.createDataFrame([(i % 80, rnd.gauss(0, 1)) for i in range(2400)], "g int, x double")
    got = dict(exact_quantiles(df, "x", 0.4, "g", accuracy=20, pick_max=8).collect())
    assert got == pytest.approx(dict(df.groupBy("g").agg(F.percentile("x", 0.4)).collect()))


def test_profiles_of_other_columns(spark):
    df = spark.createDataFrame([(i % 2, i / 3) for i in range(101)], "binary_label int, token_count double")
    want = df.groupBy("binary_label").agg(F.count("token_count"), F.avg("token_count"), F.median("token_count"), F.min("token_count"), F.max("token_count"))
    assert sorted(map(tuple, token_stats(df).collect())) == [pytest.approx(tuple(r)) for r in sorted(want.collect())]
    assert token_quantile(df).first()["p99"] == pytest.approx(33.0)
    whole = df.select("binary_label", F.col("token_count").cast("int").alias("token_count"))
    assert token_quantile(whole).first()["p99"] == token_quantile(whole.withColumn("token_count", F.col("token_count").cast("long"))).first()["p99"]
    assert exact_quantiles(df.limit(0), "token_count", 0.5).count() == 0
