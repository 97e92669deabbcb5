"""The pipeline's stages on small documents, each against a plain version."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from textlab.llm.bpe import default_vocabulary

from .texts import linked_components, shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(9)
    voc = ["river", "house", "green", "stone", "walks", "under", "light", "morning", "and", "of", "a", "to", "by", "old", "sea"]
    docs, labels = [], []
    for i in range(400):
        good = rnd.random() < 0.75
        w = [rnd.choice(voc) for _ in range(rnd.randint(5, 60))]
        text = " ".join(w).capitalize() + "." if good else " ".join(x.upper() + "!!" for x in w)
        if docs and rnd.random() < 0.3:
            text = rnd.choice(docs)[1] + rnd.choice(["", " tail"])
            good = "!!" not in text
        if rnd.random() < 0.2:
            text += f" mail a.{i}@mail.example.com now"
        docs.append((i, text, "en", f"src{i % 5 if i % 2 else 0}", len(text)))
        labels.append((i, int(good), 0))
    docs += [(400, None, None, None, None), (401, "", "en", "src1", 0), docs[3]]
    path = str(tmp_path_factory.mktemp("pipe"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_one_by_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    good = cp.quality(spark, docs, folder).cache()
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.collect()}
    assert all("!!" not in (r.text or "") or r.doc_id not in kept for r in docs.collect())
    clean = {r.doc_id for r in docs.collect() if r.text and "!!" not in r.text}
    assert len(clean & kept) >= 0.99 * len(clean)

    one = cp.near_duplicates(spark, good, folder).cache()
    sets = {r.doc_id: shingle_set(r.text, 5) for r in good.collect()}
    first = linked_components(sets, 80, 100)
    assert sorted(r.doc_id for r in one.collect()) == sorted(i for i in sets if first[i] == i)
    assert one.columns == docs.columns

    private = cp.personal_data(spark, one, folder).cache()
    text = {r.doc_id: r.text for r in one.collect()}
    for r in private.collect():
        assert "@" not in (r.text or "")
        if text[r.doc_id] is None:
            assert r.text is None
        else:
            assert ("<email>" in r.text) == ("@" in text[r.doc_id]) and r.n_chars == len(r.text)

    mixed = cp.source_mix(spark, private, folder).cache()
    assert mixed.columns == docs.columns
    own = {tuple(r) for r in private.collect()}
    assert {tuple(r) for r in mixed.collect()} <= own
    share = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.length("text") + 1).alias("n")).collect() if r.source}
    assert max(share.values()) < 2.5 * min(share.values())

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(default_vocabulary())
    want = sorted((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in mixed.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in cp.tokens(spark, mixed, folder).collect()) == want


def test_run_applies_all_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, folder)
    want = sorted((r.doc_id, list(r.ids)) for r in docs.collect())
    assert sorted((r.doc_id, list(r.ids)) for r in cp.run(spark, folder).collect()) == want
    assert 4 <= len(cp.STAGES) <= 5


def test_near_duplicates_keeps_different_texts_with_the_same_31_bits_of_hash(spark, folder):
    texts = ["MIT license 41913", "MIT license 125896"]
    docs = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in [*texts, texts[0]]], SCHEMA)
    assert docs.select(F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1))).distinct().count() == 1
    assert sorted(r.text for r in cp.near_duplicates(spark, docs, folder).collect()) == sorted(texts)
