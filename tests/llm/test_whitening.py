"""Whitening against a plain eigendecomposition, and the steps it is made of."""

import math

import numpy as np
import pytest

from textlab.llm.queries import QUERIES
from textlab.llm.whitening import Spectrum, deviations, rank_one, secular, whiten

from ..conftest import SF_CHECK
from .texts import with_clashes


def plain(rows, k=8):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} and the eigenvectors' signs left open."""
    x = np.floor(1024 * np.array([v for _, v in rows], float)) + 100000
    n, s = len(x), x.sum(0)
    c = x - s / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    keep = [i for i in range(len(e)) if e[i] > 1e-12 * e.sum()][:k]
    dev = [sum(int(n * a - b) ** 2 for a, b in zip(r, s)) for r in x.astype(int).tolist()]
    return n, dev, c @ v[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()


def same(got, rows, k=8):
    n, dev, w, share = plain(rows, k)
    by = {(r["vec_id"], r["component"]): r for r in got}
    assert len(got) == len(by) == w.size
    for j in range(w.shape[1]):
        mine = np.array([by[i, j + 1]["whitened"] for i, _ in rows])
        assert np.abs(mine * np.sign(mine @ w[:, j]) - w[:, j]).max() < 1e-8
    for (i, _), d in zip(rows, dev, strict=True):
        r = by[i, 1]
        assert (r["n"], r["deviation"]) == (n, d)
    assert np.allclose([by[rows[0][0], j + 1]["explained"] for j in range(w.shape[1])], share, rtol=1e-10)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_secular_roots_lie_between_the_poles_and_solve_the_equation():
    rng = np.random.default_rng(1)
    for k in (1, 2, 7, 40):
        d = np.sort(rng.random(k)) * 100
        z2 = rng.random(k) ** 6 + 1e-9
        origin, x = secular(d, z2)
        root = np.linalg.eigvalsh(np.diag(d) + np.sqrt(np.outer(z2, z2)))
        assert np.allclose(d[origin] + x, root, rtol=1e-13, atol=1e-12)


@pytest.mark.parametrize("kind", ["plain", "zeros", "equal", "untouched", "near"])
def test_rank_one_update(kind):
    rng = np.random.default_rng(2)
    d = np.sort(rng.random(12)) * 10
    v = rng.standard_normal(12)
    if kind == "zeros":
        d[:9] = 0.0
    elif kind == "equal":
        d[3:8] = d[3]
    elif kind == "untouched":
        v[[0, 5, 11]] = 0.0
    elif kind == "near":
        d = np.sort(d + np.repeat([0, 1e-15, 3], 4))
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    values, basis = rank_one(d, q, q @ v, 2.5)
    assert np.abs(basis.T @ basis - np.eye(12)).max() < 1e-13
    assert np.abs(basis * values @ basis.T - (q * d @ q.T + 2.5 * np.outer(q @ v, q @ v))).max() < 1e-12
    assert (np.diff(values) >= 0).all()


def test_spectra_of_parts_combine_to_the_spectrum_of_all():
    x = np.floor(1024 * np.random.default_rng(3).standard_normal((400, 12))).astype(np.int64) + 100000
    x[:, 7], x[200:260] = x[:, 6], x[200]
    parts = []
    for a, b in ((0, 5), (5, 230), (230, 400)):
        s = Spectrum(12)
        for c in range(a, b, 40):
            s.add(x[c : min(b, c + 40)])
        parts.append(Spectrum.unpack(*s.pack()))
    parts[0].merge(parts[1])
    parts[2].merge(parts[0])
    c = x - x.mean(0)
    assert np.allclose(parts[2].values, np.linalg.eigvalsh(c.T @ c), rtol=1e-11, atol=1e-3)
    assert (parts[2].sums == x.sum(0)).all() and parts[2].n == 400


def test_whole_table(spark):
    got = QUERIES["op11_whitening"](spark, SF_CHECK).collect()
    same(got, sorted(map(tuple, spark.read.parquet(f"{SF_CHECK}/embeddings.parquet").select("vec_id", "embedding").collect())))


def test_nulls_repeats_and_clashing_columns(spark):
    x = np.random.default_rng(4).standard_normal((90, 6)) * [5, 4, 3, 2, 1, 1]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(500, None), (501, [None] * 6), (502, [math.nan] * 6), (503, [1.0] * 5 + [math.inf]), (504, [])]
    df = with_clashes(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).repartition(40)
    same(whiten(df, components=4, fan_in=2).collect(), rows, 4)
    # null and repeated ids, and repeated rows, count as they stand
    again = [(None, v) for _, v in rows[:30]] + [(7, v) for _, v in rows[30:]] + [(7, rows[30][1])]
    again = spark.createDataFrame(again, "vec_id long, embedding array<double>")
    got = whiten(again, components=4).collect()
    assert len(got) == 4 * 91 and {r["n"] for r in got} == {91} and sum(r["vec_id"] is None for r in got) == 120


def test_directions_without_variance_lengths_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(i, [float(i), 2.0 * i, 1.0, float(i * i % 7)]) for i in range(30)]  # rank 2
    same(whiten(spark.createDataFrame(rows, schema)).collect(), rows)
    short = [(100 + i, [float(i % 3), float(i % 5)]) for i in range(15)]
    both = whiten(spark.createDataFrame(rows + short, schema).repartition(3)).collect()
    same([r for r in both if r["vec_id"] < 100], rows)
    same([r for r in both if r["vec_id"] >= 100], short)
    assert whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], schema)).count() == 0
    assert whiten(spark.createDataFrame([], schema)).count() == 0


def test_deviations_are_exact_beyond_the_products_of_longs():
    x = np.array([[100000, 5 * 10**9], [100001, 7]])
    n, sums = 10**6, np.array([3, 11])
    away, squares = deviations(x, n, sums)
    assert squares == [sum((n * a - s) ** 2 for a, s in zip(r, [3, 11])) for r in x.tolist()]
