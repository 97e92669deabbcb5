"""Poisson replication against the same draws in plain Python."""

import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textlab.llm import mixing
from textlab.llm.mixing import poisson_mix


def plain(rows, weights=None, budget=None):
    mass = Counter()
    for _, s, t in rows:
        mass[s] += len(t or "") + 1
    w = {s: 1.0 for s in mass} if weights is None else {s: weights.get(s, 0.0) for s in mass}
    out = []
    for i, s, _ in rows:
        rate = (budget or sum(mass.values())) * w[s] / (sum(w.values()) or 1) / mass[s]
        draws = max(1, math.ceil(rate / 256))
        n = 0
        for j in range(1, draws + 1):
            key = f"mix-1:{'null' if i is None else i}:{j}"
            u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
            p = cdf = math.exp(-rate / draws)
            k = 0
            while cdf <= u:
                k += 1
                p *= rate / draws / k
                cdf += p
            n += k
        out += [(i, s, c) for c in range(1, n + 1)]
    return Counter(out)


def rows():
    out = [(i, f"s{i % 7 if i % 3 else 0}", "x" * (i * 37 % 400)) for i in range(600)]
    return out + [(600, None, None), (601, None, ""), (None, "s1", "null id"), (5, "s5", "again"), (5, "s5", "again")]


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, source string, text string").repartition(3)


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_copies(spark, monkeypatch, broadcast):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    got = Counter((r.doc_id, r.source, r.copy) for r in poisson_mix(frame(spark, rows())).collect())
    assert got == plain(rows())


def test_weights_and_budget(spark):
    weights = {"s0": 3.0, "s1": 1.0}
    got = Counter((r.doc_id, r.source, r.copy) for r in poisson_mix(frame(spark, rows()), weights, 50_000.0).collect())
    assert got == plain(rows(), weights, 50_000.0)
    assert {s for _, s, _ in got} <= {"s0", "s1"}


def test_masses_come_out_at_the_weights(spark):
    data = [(i, "big" if i % 10 else "small", "y" * 50) for i in range(20_000)]
    got = {r.source: r["count"] for r in poisson_mix(frame(spark, data)).groupBy("source").count().collect()}
    assert abs(got["big"] - 10_000) < 400 and abs(got["small"] - 10_000) < 700


def test_large_rates_are_sums_of_draws(spark):
    data = [(i, "only", "z") for i in range(20)]
    got = poisson_mix(frame(spark, data), budget=2.0 * 20 * 1000).groupBy("doc_id").count().collect()
    assert len(got) == 20 and all(abs(r["count"] - 1000) < 6 * math.sqrt(1000) for r in got)


def test_order_columns_and_edges(spark):
    df = frame(spark, rows()).withColumn("copy", F.lit("mine")).withColumn("rate_cdf", F.lit(1))
    out = poisson_mix(df)
    assert out.columns == ["doc_id", "source", "text", "copy", "rate_cdf", "_copy", "shuffle_key"]
    keys = [r.shuffle_key for r in out.collect()]
    assert keys == sorted(keys)
    assert poisson_mix(df.filter("doc_id < 0")).count() == 0
    assert poisson_mix(df, {"absent": 1.0}).count() == 0
    with pytest.raises(ValueError):
        poisson_mix(df, {"s0": -1.0})


def test_rows_under_one_id_draw_each_for_itself(spark):
    data = [(None, "a", f"null {i}" + "x" * 40) for i in range(2000)] + [(7, "a", f"again {i}" + "x" * 40) for i in range(2000)]
    data += [(None, "a", "same")] * 2000 + [(i, "b", "y" * 400) for i in range(100, 400)]
    df = frame(spark, data)
    mass = sum(len(t) + 1 for _, _, t in data)
    rate = 0.5 * mass / sum(len(t) + 1 for _, s, t in data if s == "a")
    out = poisson_mix(df, by_row=True)
    got = out.collect()
    for kind in ("null", "again", "same"):
        n = sum(r.text.startswith(kind) for r in got)
        assert abs(n - 2000 * rate) < 6 * math.sqrt(2000 * rate), kind
    assert len({r.shuffle_key for r in got}) == len(got) and [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    # unique ids keep their draws, and the dealing of the rows does not matter
    unique = lambda rows: Counter((r.doc_id, r.copy, r.shuffle_key) for r in rows if r.source == "b")
    assert unique(got) == unique(poisson_mix(df).collect())
    assert sorted(r.shuffle_key for r in poisson_mix(df.repartition(7), by_row=True).collect()) == [r.shuffle_key for r in got]


def test_registered_query_under_null_and_repeated_ids(spark, tmp_dir):
    """A third of all rows under a null id, others under one id and listed twice: as the SQL says, and at the target weights."""
    import duckdb

    from textlab.llm.queries import QUERIES, SQL

    data = [(None, f"null {i}" + "x" * 60, "en", "a", 7) for i in range(900)] + [(7, f"again {i}" + "x" * 60, None, "a", None) for i in range(300)]
    data += [(None, "z" * 500, "en", None, 0)] * 200 + [(None, None, None, "a", 0)] * 50 + [(i, "y" * 400, "de", "b", 400) for i in range(100, 900)] + [(100, "y" * 400, "de", "b", 400)] * 3
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(f"{tmp_dir}/documents.parquet")
    got = Counter(map(tuple, QUERIES["op9_poisson_mix"](spark, tmp_dir).collect()))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_dir}/documents.parquet/*.parquet')")
    assert got == Counter(con.sql(SQL["op9_poisson_mix"]).fetchall())
    mass = {s: sum(len(t or "") + 1 for _, t, _, x, _ in data if x == s) for s in ("a", "b", None)}
    for source in mass:
        rows_in = sum(x == source for *_, x, _ in data)
        want = rows_in * sum(mass.values()) / 3 / mass[source]
        assert abs(sum(n for (_, s, _, _), n in got.items() if s == source) - want) < 6 * math.sqrt(want), source


def test_rows_with_one_shuffle_key_are_dealt_to_several_tasks(spark):
    df = frame(spark, [(None, "s", f"text {i}") for i in range(4000)])
    out = poisson_mix(df, budget=60_000.0)
    assert out.select("shuffle_key").distinct().count() < 40
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = out.groupBy(F.spark_partition_id().alias("p"), "shuffle_key").count().groupBy("shuffle_key").count()
        assert parts.agg(F.max("count")).first()[0] > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
