"""Held-out accuracy and edges of the quality classifier."""

import random
import zlib

from pyspark.sql import functions as F

from textlab.llm import quality as q

from .texts import with_clashes


def data(n=900):
    rnd = random.Random(3)
    voc = ["the", "river", "house", "green", "stone", "walks", "under", "light", "morning", "and", "of", "a"]
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        w = [rnd.choice(voc) for _ in range(rnd.randint(3, 60))]
        text = " ".join(w).capitalize() + "." if good else rnd.choice([" ".join(x.upper() + "!!" for x in w), " ".join([w[0]] * len(w)), " | ".join(w) + "$$$"])
        docs.append((i, text))
        if i % 4:
            labels.append((i, int(good)))
    return docs, labels


def frames(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return d, spark.createDataFrame(labels, "doc_id long, quality int")


def test_held_out_accuracy(spark):
    docs, labels = data()
    d, lab = frames(spark, docs, labels)
    got = {r.doc_id: r for r in q.quality_scores(with_clashes(d), lab).collect()}
    assert len(got) == len(docs)
    out = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in docs)
    assert sum(got[i].predicted == y for i, y in out) / len(out) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs, labels = data(300)
    d, lab = frames(spark, docs, labels)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a = {r.doc_id: r.score for r in q.quality_scores(d, lab).collect()}
    b = q.quality_scores(d.withColumn("lang", F.lit("zz")), spark.createDataFrame(flipped, "doc_id long, quality int"), keep=("lang",))
    assert {r.doc_id: r.score for r in b.collect()} == a
    assert b.columns == ["doc_id", "held_out", "score", "predicted", "lang"]


def test_edges(spark):
    docs, labels = data(60)
    extra = [(None, "null id"), (5, None), (5, ""), (5, "same"), (5, "same"), (1000, "long word " * 5000)]
    d, lab = frames(spark, docs + extra, labels + [(3, None), (None, 1), (7, 0), (7, 1)])
    rows = q.quality_scores(d, lab).collect()
    assert len(rows) == len(docs) + len(extra) and not any(r.held_out for r in rows if r.doc_id is None)
    none = lab.filter("doc_id < 0")
    assert {r.score for r in q.quality_scores(d, none).collect()} == {0.5}
    assert {r.predicted for r in q.quality_scores(d, lab.withColumn("quality", F.lit(0))).collect()} == {0}
    assert q.quality_scores(d.filter("doc_id < 0"), lab).count() == 0


def test_fit_bound(spark):
    docs, labels = data(400)
    d, lab = frames(spark, docs, labels)
    assert q.quality_scores(d, lab, fit_rows=50).count() == 400


def test_labels_of_other_documents_take_no_place(spark):
    docs, labels = data(200)
    d, lab = frames(spark, docs, labels)
    others = spark.range(10_000, 60_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    a = {r.doc_id: r.score for r in q.quality_scores(d, lab, fit_rows=60).collect()}
    b = {r.doc_id: r.score for r in q.quality_scores(d, lab.unionByName(others), fit_rows=60).collect()}
    assert a == b and len(set(a.values())) > 50


def test_repeated_rows_take_one_place(spark):
    docs, labels = data(200)
    i, text = next((i, t) for i, t in docs if dict(labels).get(i) is not None and zlib.crc32(str(i).encode()) % 3 != 1)
    d, lab = frames(spark, docs, labels)
    again, _ = frames(spark, docs + [(i, text)] * 500, labels)
    a = {r.doc_id: r.score for r in q.quality_scores(d, lab, fit_rows=60).collect()}
    b = {r.doc_id: r.score for r in q.quality_scores(again, lab, fit_rows=60).collect()}
    assert a == b
