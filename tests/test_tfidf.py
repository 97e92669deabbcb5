"""TF-IDF against a plain-Python implementation of the same definition, and plan shape."""

import math
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textlab.operators import tfidf

from .conftest import SF_SMALL


def py_terms(s):
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    toks = re.findall(r"(?u)\b\w\w+\b", s)
    return toks + [" ".join(toks[i:i + 2]) for i in range(len(toks) - 1)]


def py_tfidf(train, other):
    n = len(train)
    dfc = Counter(t for _, txt in train for t in set(py_terms(txt)))
    vocab = sorted(t for t, c in dfc.items() if c >= 2 and c <= 0.95 * n)
    idf = {t: math.log((1 + n) / (1 + dfc[t])) + 1 for t in vocab}
    out = {}
    for key, txt in other:
        tf = Counter(t for t in py_terms(txt) if t in idf)
        w = {t: (1 + math.log(c)) * idf[t] for t, c in tf.items()}
        nr = math.sqrt(sum(v * v for v in w.values()))
        out[key] = {t: v / nr for t, v in w.items()} if nr > 0 else {}
    return vocab, out


@pytest.fixture(scope="module")
def docs(spark):
    d = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id"), "text")
    return d


def expected_matches(got, expect):
    assert set(got) == set(expect)
    for k, e in expect.items():
        assert set(got[k]) == set(e)
        for t, x in e.items():
            assert got[k][t] == pytest.approx(x, abs=1e-12)
        if e:
            assert sum(x * x for x in got[k].values()) == pytest.approx(1.0, abs=1e-12)


@pytest.mark.parametrize("bound", [None, 0])
def test_tfidf_matches_definition(spark, docs, monkeypatch, bound):
    if bound is not None:  # the shuffled lookup
        monkeypatch.setattr(tfidf, "VOCAB_BROADCAST_MAX_BYTES", bound)
    train = docs.filter("doc_id % 10 < 8")
    other = docs.filter("doc_id % 10 >= 8")
    v = tfidf.fit_vocabulary(train)
    rows_tr = [(r.doc_id, r.text) for r in train.collect()]
    rows_ot = [(r.doc_id, r.text) for r in other.collect()]
    vocab, expect = py_tfidf(rows_tr, rows_ot)
    assert [r.term for r in v.table.orderBy("idx").collect()] == vocab
    packed = tfidf.transform(other, v, carry=["doc_id"], keep_terms=True)
    expected_matches({r.doc_id: dict(zip(r.terms, r.val)) for r in packed.collect()}, expect)


@pytest.mark.parametrize("bound", [None, 0])
def test_rows_that_share_a_key_stay_apart(spark, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(tfidf, "VOCAB_BROADCAST_MAX_BYTES", bound)
    rows = [(1, "alpha beta"), (1, "foo bar"), (2, "foo baz"), (3, None), (3, "foo bar"), (3, "foo bar")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    v = tfidf.fit_vocabulary(df)
    assert v.n_docs == 6
    assert {r.term: r.df for r in v.table.collect()} == {"foo": 4, "bar": 3, "foo bar": 3}
    got = tfidf.transform(df, v, carry=["doc_id"], keep_terms=True).collect()
    assert sorted((r.doc_id, sorted(r.terms)) for r in got) == [
        (1, []), (1, ["bar", "foo", "foo bar"]), (2, ["foo"]), (3, []), (3, ["bar", "foo", "foo bar"]), (3, ["bar", "foo", "foo bar"]),
    ]
    tc = tfidf.term_counts(df, carry=["doc_id"]).collect()
    assert sorted((r.doc_id, r.term, r.tf) for r in tc if r.doc_id == 1) == [
        (1, "alpha", 1), (1, "alpha beta", 1), (1, "bar", 1), (1, "beta", 1), (1, "foo", 1), (1, "foo bar", 1)]


def test_transform_and_score_shuffle_nothing(spark, docs):
    from textlab.operators.linear import decision_score

    v = tfidf.fit_vocabulary(docs.filter("doc_id % 10 < 8"))
    packed = tfidf.transform(docs, v, carry=["doc_id"])
    coef = v.table.select("idx", F.lit(0.5).alias("coef"))
    plan = decision_score(packed, coef, 0.1, ["doc_id"], v.size)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan


@pytest.mark.parametrize("limit", [10_000_000, 0])
def test_decision_score_per_row(spark, limit):
    from textlab.operators.linear import decision_score

    df = spark.createDataFrame([(1, [0, 2], [1.0, 2.0]), (1, [], []), (2, [5], [1.0])], "k int, idx array<bigint>, val array<double>")
    coef = spark.createDataFrame([(0, 0.5), (2, -1.0)], "idx bigint, coef double")
    got = decision_score(df, coef, 0.25, ["k"], broadcast_max=limit).collect()
    assert sorted((r.k, r.score) for r in got) == [(1, -1.25), (1, 0.25), (2, 0.25)]


def test_vocabulary_index_is_dense(spark, docs):
    v = tfidf.fit_vocabulary(docs)
    idx = sorted(r.idx for r in v.table.select("idx").collect())
    assert idx == list(range(v.size))
    assert dict(v.table.dtypes)["idx"] == "bigint"


def test_term_table_finds_terms_as_text(monkeypatch):
    import pandas as pd
    import pyarrow as pa

    from textlab.operators.tfidf import TermTable

    terms = pa.array(sorted({f"term {i}" for i in range(500)} | {"é", "漢字", ""}))
    asked = pa.array(["term 7", "nothing", "漢字", "", "term 499", "term 7", "é"])
    want = [terms.to_pylist().index(t) if t in set(terms.to_pylist()) else -1 for t in asked.to_pylist()]
    assert TermTable(terms).find(asked).tolist() == want
    assert TermTable(terms).find(asked.slice(2, 2)).tolist() == want[2:4]
    assert TermTable(terms.slice(0, 0)).find(asked).tolist() == [-1] * 7
    assert TermTable(terms).find(asked.slice(0, 0)).tolist() == []
    real = pd.util.hash_array
    # hashes that collide: with terms that are not known (compared as text), and among the known (another key)
    monkeypatch.setattr(pd.util, "hash_array", lambda v, hash_key, categorize: real(v, hash_key=hash_key, categorize=categorize) % (3 if hash_key == "0" * 16 else 10**6))
    table = TermTable(terms)
    assert table.key != "0" * 16
    many = pa.array([f"other {i}" for i in range(20000)] + asked.to_pylist())
    assert table.find(many).tolist() == [-1] * 20000 + want


def test_words_reach_python_in_bounded_slices():
    import pyarrow as pa

    words = ["ab cd " * i for i in (1, 400, 2, 0, 3, 900)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(words)], ["k", "w"])
    parts = list(tfidf._slices(batch, 3000))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(6))
    assert all(p.num_rows == 1 or p.column(1).nbytes <= 3000 for p in parts) and len(parts) > 1
    row, code, tf, terms = tfidf._counted(pa.array(["ab cd ab cd", "", "cd", "ab cd"]).slice(1))
    got = [(r, terms[c].as_py(), n) for r, c, n in zip(row.tolist(), code.tolist(), tf.tolist())]
    assert sorted(got) == [(1, "cd", 1), (2, "ab", 1), (2, "ab cd", 1), (2, "cd", 1)]


def test_no_term_array_reaches_python(spark):
    df = spark.createDataFrame([(1, "alpha beta alpha beta"), (1, None)], "k int, text string")
    counted = tfidf.term_counts(df, carry=["k"])
    assert "_terms" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, counted.collect())) == [(1, "alpha", 2), (1, "alpha beta", 2), (1, "beta", 2), (1, "beta alpha", 1)]


def test_a_chunk_asks_for_a_term_once(spark, monkeypatch):
    """A hundred rows of the same words: the join with a large vocabulary carries their distinct terms, not their entries."""
    monkeypatch.setattr(tfidf, "VOCAB_BROADCAST_MAX_BYTES", 0)
    df = spark.createDataFrame([(i, "alpha beta gamma") for i in range(100)] + [(100, "none of these"), (101, None)], "k int, text string").coalesce(1)
    vocab = tfidf.fit_vocabulary(df, max_df=1.0)
    paths = []
    real = tfidf.scratch_path
    monkeypatch.setattr(tfidf, "scratch_path", lambda s, name: paths.append(real(s, name)) or paths[-1])
    got = {r.k: r for r in tfidf.transform(df, vocab, carry=["k"], keep_terms=True).collect()}
    assert len(got) == 102 and got[100].terms == [] and got[101].idx == []
    assert all(sorted(got[i].terms) == ["alpha", "alpha beta", "beta", "beta gamma", "gamma"] for i in range(100))
    asked = sum(len([t for t in r.terms if t]) for r in spark.read.parquet(paths[0]).collect())
    assert asked == 10  # five of the hundred rows, five of the one with other words


def test_decisions_of_several_models_where_nothing_is_broadcast(spark, docs, monkeypatch):
    from textlab.operators.linear import decision_scores

    vocab = tfidf.fit_vocabulary(docs.filter("doc_id % 10 < 8"))
    coefs = vocab.table.filter("idx % 3 > 0").select("idx", F.array(F.col("idx") % 7 / 7.0, F.length("term") / 10.0, F.lit(-1.0)).alias("coefs"))
    rows = docs.unionByName(spark.createDataFrame([(-1, None), (-1, "qqqq zzzz"), (-2, "")], "doc_id long, text string"))
    want = decision_scores(tfidf.transform(rows, vocab, carry=["doc_id"]), coefs, [0.5, 0.0, 2.0], ["doc_id"]).collect()
    monkeypatch.setattr(tfidf, "CHUNK_BYTES", 4000)
    got = tfidf.decisions(rows, vocab, coefs, [0.5, 0.0, 2.0], carry=["doc_id"]).collect()
    key = lambda r: (r.doc_id, [round(x, 9) for x in r.scores])
    assert len(got) == len(want) == docs.count() + 3
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a.doc_id == b.doc_id and a.scores == pytest.approx(b.scores, abs=1e-12)
    alone = rows.filter("doc_id < 0")  # a chunk without any known term
    assert [r.scores for r in tfidf.decisions(alone, vocab, coefs, [0.5, 0.0, 2.0]).collect()] == [[0.5, 0.0, 2.0]] * 3


def test_counted_terms_travel_packed(spark):
    """One exchange, of a row per chunk, bucket and count instead of one per term; rows that hold a term count once."""
    texts = [" ".join(f"w{(i * 7 + j) % 900}" for j in range(300)) for i in range(40)] + ["x1 x2 x1 x2 x1", "", "é é", "a b"]
    df = spark.createDataFrame([(t,) for t in texts + [None]], "text string").coalesce(1)
    counts = tfidf.document_counts(df)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "packed" in plan.split("Exchange")[1]
    want = Counter(t for s in texts for t in set(py_terms(s)))
    got = {r.term: r.df for r in counts.collect()}
    assert got.pop(None) == len(texts) + 1 and got == want
    sent = counts.sparkSession.createDataFrame([], "text string")
    assert tfidf.document_counts(sent).collect() == []
    assert tfidf.fit_vocabulary(sent).size == 0


def test_packed_numbers():
    import numpy as np

    for numbers in ([], [5], [2**31 - 1, 0, -3, 2**31 - 1, -(2**31)], range(0, 3000, 3)):
        x = np.array(list(numbers), np.int64)
        assert tfidf._unpacked(tfidf._packed(x)).tolist() == x.tolist()
    assert len(tfidf._packed(np.arange(100_000))) < 1000


def test_the_lookup_of_a_large_vocabulary_sends_packed_terms(spark, monkeypatch):
    df = spark.createDataFrame([(i, "alpha beta gamma") for i in range(20)], "k int, text string")
    vocab = tfidf.fit_vocabulary(df, max_df=1.0)
    monkeypatch.setattr(tfidf, "VOCAB_BROADCAST_MAX_BYTES", 0)
    coefs = vocab.table.select("idx", F.array(F.lit(1.0)).alias("coefs"))
    plan = tfidf.decisions(df, vocab, coefs, [0.0], carry=["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join [term" not in plan and "hashpartitioning(bucket" in plan and "hashpartitioning(term" not in plan


def test_words_found_before_are_taken_as_they_are(spark):
    """The fits find the words of the training rows once, for the vocabulary and the rows."""
    docs = spark.createDataFrame([(1, "Ein Haus, ein Baum"), (2, "ein Haus am See"), (3, None), (4, "Baum und See und Haus")], "k int, text string")
    once = tfidf.worded(docs, carry=["k"])
    assert "text" not in once.columns
    vocab, again = tfidf.fit_vocabulary(docs), tfidf.fit_vocabulary(once)
    assert again.n_docs == 4 and sorted(again.table.collect()) == sorted(vocab.table.collect())
    assert sorted(tfidf.transform(once, again, carry=["k"]).collect()) == sorted(tfidf.transform(docs, vocab, carry=["k"]).collect())


def test_buckets_and_order_of_terms():
    """A term has one bucket wherever it is met, and its place is that of its text in sorted order."""
    words = ["ab", "abc", "é_", "zz", "中文", "𝒳x", "0a", "a_"]
    terms = words + [f"{a} {b}" for a in words for b in words]
    parts = tfidf._parts(pa.array(terms))
    place = {t: i for i, t in enumerate(sorted(terms, key=lambda t: t.encode()))}
    assert tfidf._ranks(parts).tolist() == [place[t] for t in terms]
    buckets = dict(zip(terms, tfidf._buckets(parts, 1000).tolist()))
    for t in terms:
        assert tfidf._buckets(tfidf._parts(pa.array([t])), 1000).tolist() == [buckets[t]]
    assert all(len({buckets[t] for t in terms if t.split(" ")[0] == w}) <= tfidf.SPREAD for w in words)
    assert len(set(buckets.values())) > 20
