"""Distributed solver: optimality against a numpy Newton solve of the same objective."""

import numpy as np
import pytest

from pyspark.accumulators import AccumulatorParam
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from textlab.operators import evaluate, solver
from textlab.operators.linear import decision_score, decision_scores, gradient_norm, training_rows
from textlab.operators.solver import dual_start, fit_linear, fit_linears, prepare


def make_rows(spark, n=80, d=6, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    X[rng.random((n, d)) < 0.4] = 0.0
    y = (X @ rng.normal(size=d) + 0.3 * rng.normal(size=n) > 0.4).astype(int)
    s = np.where(y == 1, n / (2 * max(y.sum(), 1)), n / (2 * max((1 - y).sum(), 1)))
    rows = []
    for i in range(n):
        nz = np.nonzero(X[i])[0]
        rows.append((int(y[i]), float(s[i]), [int(j) for j in nz], [float(X[i, j]) for j in nz]))
    df = spark.createDataFrame(rows, "y int, s double, idx array<bigint>, val array<double>").repartition(3)
    return df, X, y, s


def newton(X, y, s, C, loss, iters=100):
    """Exact minimiser of 1/2|w,b|^2 + C sum s_i loss_i (bias regularised)."""
    n, d = X.shape
    A = np.hstack([X, np.ones((n, 1))])
    ys = 2.0 * y - 1.0
    w = np.zeros(d + 1)
    for _ in range(iters):
        z = ys * (A @ w)
        if loss == "logistic":
            p = 1 / (1 + np.exp(z))
            g = w - C * A.T @ (s * ys * p)
            H = np.eye(d + 1) + C * (A.T * (s * p * (1 - p))) @ A
        else:
            act = (z < 1).astype(float)
            g = w - 2 * C * A.T @ (s * ys * np.maximum(0, 1 - z))
            H = np.eye(d + 1) + 2 * C * (A.T * (s * act)) @ A
        step = np.linalg.solve(H, g)
        w -= step
        if np.linalg.norm(step) < 1e-14:
            break
    return w


PROBLEMS = [("logistic", 2.0), ("squared_hinge", 1.0)]


def dense(coef, d):
    w = np.zeros(d)
    for i, x in coef.collect():
        w[i] = x
    return w


@pytest.mark.parametrize("start", [True, False])
def test_default_tolerance_reaches_the_optimum(spark, start):
    df, X, y, s = make_rows(spark)
    for (loss, C), (coef, b, info) in zip(PROBLEMS, fit_linears(df, PROBLEMS, start=start)):
        assert np.allclose(np.append(dense(coef, X.shape[1]), b), newton(X, y, s, C, loss), atol=1e-6)
        assert info["grad_norm"] < 1e-6 and info["n_rows"] == len(y)
        assert gradient_norm(df, coef, b, loss, C).first()["grad_norm"] < 1e-6


def test_many_tiles_blocks_and_pieces(spark, monkeypatch):
    for name, value in (("PIECE", 7), ("BLOCK_ROWS", 9), ("DRIVER_SUM_BYTES", 0)):
        monkeypatch.setattr(solver, name, value)
    df, X, y, s = make_rows(spark)
    problem = prepare(df, tile_entries=40)
    assert problem.n_tiles > 3 and problem.tiles.count() > 3
    a = np.linspace(-1, 1, len(y))
    # rows come in the order of the written blocks; the inner products tell them apart
    images = problem.multiply([a, problem.y])
    order = [int(np.flatnonzero(np.isclose(s * (2 * y - 1), v))[0]) for v in problem.s * problem.y]
    assert len(order) == len(y) and images[0].shape == a.shape
    assert float(problem.y @ images[1]) == pytest.approx(float((2 * y - 1) @ X @ X.T @ (2 * y - 1)))
    monkeypatch.setattr(solver, "TILE_ENTRIES", 40)
    coef, b, _ = fit_linear(df, "logistic", 2.0, start=False)
    assert np.allclose(np.append(dense(coef, X.shape[1]), b), newton(X, y, s, 2.0, "logistic"), atol=1e-6)


def test_no_vector_is_as_wide_as_the_vocabulary(spark):
    """Feature numbers of 10^12 and more: any vector indexed by feature, on the driver or in a task, would not fit."""
    df, X, y, s = make_rows(spark)
    wide = df.withColumn("idx", F.transform("idx", lambda i: i * F.lit(10**12) + 5))
    for (loss, C), (coef, b, info) in zip(PROBLEMS, fit_linears(wide, PROBLEMS, start=False)):
        w = dense(coef.select(((F.col("idx") - 5) / 10**12).cast("long"), "coef"), X.shape[1])
        assert np.allclose(np.append(w, b), newton(X, y, s, C, loss), atol=1e-6)
        assert gradient_norm(wide, coef, b, loss, C).first()["grad_norm"] < 1e-6


def test_dual_steps_alone_come_close_to_the_optimum(spark):
    df, X, y, s = make_rows(spark)
    problem = prepare(df)
    for (loss, C), (a, image, b) in zip(PROBLEMS, dual_start(problem, PROBLEMS)):
        best = newton(X, y, s, C, loss)
        assert b == pytest.approx(best[-1], abs=2e-3)
        assert np.allclose(dense(problem.coefficients([a]).selectExpr("idx", "coefs[0]"), X.shape[1]), best[:-1], atol=2e-3)
    assert dual_start(problem, PROBLEMS, part_entries=5) == [None, None]


def test_rows_without_features_and_without_rows(spark):
    rows = spark.createDataFrame([(1, 1.0, [], []), (0, 1.0, [], []), (1, 1.0, [], [])], "y int, s double, idx array<bigint>, val array<double>")
    coef, b, info = fit_linear(rows, "logistic", 2.0)
    assert coef.count() == 0 and 0 < b < 1 and info["grad_norm"] < 1e-6
    coef, b, info = fit_linear(rows.filter("y = 7"), "squared_hinge", 1.0)
    assert coef.count() == 0 and b == 0 and info["n_rows"] == 0


def test_every_step_is_kept_and_scored(spark):
    df, X, y, s = make_rows(spark)
    coef, b, info = fit_linear(df, "squared_hinge", 1.0, start=False, keep_steps=True)
    coefs, biases = info["steps"]
    assert len(biases) == len(info["history"]) == info["iterations"] + 1 > 3
    assert biases[0] == 0 and biases[-1] == b
    last = dict(coefs.selectExpr("idx", f"coefs[{len(biases) - 1}]").collect())
    assert last == pytest.approx(dict(coef.collect()))
    rows = df.withColumn("id", F.monotonically_increasing_id())
    for limit in (10**6, 0):  # in the row, and joined
        got = {r["id"]: r["scores"] for r in decision_scores(rows, coefs, biases, ["id"], broadcast_max=limit).collect()}
        for k in (0, 2, len(biases) - 1):
            one = decision_score(rows, coefs.select("idx", F.col("coefs")[k].alias("coef")), biases[k], ["id"])
            assert {r["id"]: r["score"] for r in one.collect()} == pytest.approx({i: v[k] for i, v in got.items()})
    table = evaluate.step_metrics(decision_scores(rows, coefs, biases, ["y"]), "y").orderBy("step").collect()
    assert [r["step"] for r in table] == list(range(len(biases)))
    for r in (table[0], table[-1]):
        w = dense(coefs.select("idx", F.col("coefs")[r["step"]]), X.shape[1])
        p = X @ w + biases[r["step"]] >= 0
        tp, fp, fn = int((p & (y == 1)).sum()), int((p & (y == 0)).sum()), int((~p & (y == 1)).sum())
        assert (r["tp"], r["fp"], r["fn"]) == (tp, fp, fn) and r["f1_pos"] == pytest.approx(2 * tp / max(1, 2 * tp + fp + fn))


def test_gradient_norm_away_from_the_optimum(spark):
    df, X, y, s = make_rows(spark)
    w = np.linspace(-1, 1, X.shape[1])
    coef = spark.createDataFrame([(i, float(x)) for i, x in enumerate(w)], "idx bigint, coef double")
    A, ys, wb = np.hstack([X, np.ones((len(y), 1))]), 2.0 * y - 1.0, np.append(w, 0.3)
    z = ys * (A @ wb)
    for loss, C in PROBLEMS:
        d = -ys / (1 + np.exp(z)) if loss == "logistic" else -2 * ys * np.maximum(0, 1 - z)
        want = np.linalg.norm(wb + C * A.T @ (s * d))
        assert gradient_norm(df, coef, 0.3, loss, C).first()["grad_norm"] == pytest.approx(want)


def test_fit_rows_are_bounded(spark):
    df, *_ = make_rows(spark, n=400)
    weights = spark.createDataFrame([(0, 1.0), (1, 1.0)], "label int, weight double")
    packed = df.select(F.col("y").alias("binary_label"), "idx", "val")
    assert 60 < training_rows(packed, weights, max_rows=100).count() < 140
    assert training_rows(packed, weights).count() == 400


def drive(loss, c, y, K, tol):
    """The descent alone, with a dense product for the passes."""
    solver_ = solver.descend(loss, c, y, None, tol, 1000, 40)
    asked = next(solver_)
    try:
        while True:
            asked = solver_.send(K @ asked)
    except StopIteration as end:
        return end.value


def test_descent_goes_on_where_the_objective_stands_still():
    """Near the optimum of a large objective the steps still lower the gradient, though the objective no longer shows it."""
    rng = np.random.default_rng(5)
    X = rng.normal(size=(600, 300)) / 17.0
    X[:, 0] += 0.5
    y, c = np.where(rng.random(600) < 0.5, 1.0, -1.0), np.full(600, 100.0)
    assert drive("squared_hinge", c, y, X @ X.T, 1e-4)[3] <= 1e-4


def test_steps_are_taken_in_groups(spark, monkeypatch):
    """No more row vectors than a group's are held for the coefficients of the steps; all groups come back as one table."""
    df, X, y, s = make_rows(spark)
    whole = fit_linear(df, "logistic", 2.0, start=False, keep_steps=True)[2]["steps"]
    monkeypatch.setattr(solver, "COEF_BYTES", 3 * 8 * len(y))
    monkeypatch.setattr(solver, "COEF_SLICE", 4)
    real, seen = solver.Coefficients.flush, []
    monkeypatch.setattr(solver.Coefficients, "flush", lambda self: (seen.append(len(self.waiting)), real(self)))
    coefs, biases = fit_linear(df, "logistic", 2.0, start=False, keep_steps=True)[2]["steps"]
    assert max(seen) <= 3 and sum(1 for n in seen if n == 3) > 1
    assert biases == pytest.approx(whole[1])
    want = dict(whole[0].collect())
    for idx, got in coefs.collect():
        assert got == pytest.approx(want.pop(idx))
    assert not want


def test_rows_go_to_python_in_batches_of_a_block(spark, monkeypatch):
    """Rows are wide, so a batch of the default 10,000 would fill an executor; the setting comes back afterwards."""
    monkeypatch.setattr(solver, "BLOCK_ROWS", 50)
    seen, real = [], DataFrame.mapInArrow

    def watched(self, func, schema, *a, **k):
        def told(batches):
            for out in func(x if not largest.add(x.num_rows) else x for x in batches):
                yield out

        largest = spark.sparkContext.accumulator(0, Most())
        seen.append(largest)
        return real(self, told, schema, *a, **k)

    monkeypatch.setattr(DataFrame, "mapInArrow", watched)
    df, X, y, s = make_rows(spark, n=900)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    problem = prepare(df)
    assert 0 < seen[0].value <= 50 and len(problem.y) == 900
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


class Most(AccumulatorParam):
    def zero(self, value):
        return 0

    def addInPlace(self, a, b):
        return max(a, b)


def test_every_labelled_row_is_fitted(spark):
    """A million rows and more are fitted whole: no default of the row choice drops any."""
    weights = spark.createDataFrame([(0, 1.0), (1, 1.0)], "label int, weight double")
    packed = spark.range(1_000_500).select(
        (F.col("id") % 2).cast("int").alias("binary_label"), F.array("id").alias("idx"), F.array(F.lit(1.0)).alias("val"))
    assert training_rows(packed, weights).count() == 1_000_500


def test_solver_all_one_class(spark):
    df, X, y, s = make_rows(spark)
    coef, b, info = fit_linear(df.withColumn("y", F.lit(1)), "logistic", 2.0)
    assert b > 0 and np.isfinite(dense(coef, X.shape[1])).all()


def test_partial_vectors_are_as_many_as_tasks_run_at_once(spark, monkeypatch):
    """However many partitions the tiles have, a pass hands on one partial vector per running task."""
    df, X, y, s = make_rows(spark)
    problem = prepare(df, tile_entries=10)
    want = problem.multiply([problem.y])[0]
    problem.tiles = problem.tiles.repartition(12, F.monotonically_increasing_id()).persist()
    seen = []
    real = solver._joined
    monkeypatch.setattr(solver, "_joined", lambda pieces, *a: seen.append(pieces.num_rows) or real(pieces, *a))
    got = problem.multiply([problem.y])[0]
    assert np.allclose(got, want) and problem.n_tiles > 8
    assert 0 < seen[0] <= spark.sparkContext.defaultParallelism
