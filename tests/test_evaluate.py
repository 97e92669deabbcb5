"""Evaluation operators: golden numbers from the reference's committed artifacts, invariants."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlab.operators import evaluate as E
from textlab.operators import profile as P
from textlab.operators import threshold as TH
from textlab.operators.linear import class_weights


def confusion_df(spark, tp, fp, fn, tn=0):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    return spark.createDataFrame(rows, "y_true int, y_pred int")


@pytest.mark.parametrize("tp,fp,fn,p,r,f1", [
    (118, 98, 81, 0.5463, 0.5930, 0.5687),
    (126, 147, 73, 0.4615, 0.6332, 0.5339),
    (97, 151, 102, 0.3911, 0.4874, 0.4340),
])
def test_golden_metric_triples(spark, tp, fp, fn, p, r, f1):
    m = E.binary_metrics(confusion_df(spark, tp, fp, fn, 1797)).first()
    assert (m.tp, m.fp, m.fn) == (tp, fp, fn)
    assert round(m.precision, 4) == p and round(m.recall, 4) == r and round(m.f1, 4) == f1


def test_zero_division_is_zero(spark):
    m = E.binary_metrics(confusion_df(spark, 0, 0, 0, 5)).first()
    assert (m.precision, m.recall, m.f1) == (0.0, 0.0, 0.0)


def test_class_ratio_and_weights(spark):
    df = spark.createDataFrame([(0,)] * 7581 + [(1,)] * 794, "binary_label int")
    df = df.withColumn("split", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("train"))
    ratio = P.class_pivot(df).first().positive_ratio
    assert ratio == pytest.approx(0.09480597014925374, abs=1e-15)
    w = {r.label: r.weight for r in class_weights(df).collect()}
    assert round(w[0], 6) == 0.552368 and round(w[1], 6) == 5.273929


def test_fixed_grid_point_64(spark):
    g = {r.k: r.threshold for r in TH.fixed_grid(spark).collect()}
    assert len(g) == 199 and g[0] == 0.01 and g[198] == 0.99
    assert f"{g[64]:.8f}" == "0.32676768"
    assert np.array_equal(np.array([g[k] for k in range(199)]), np.linspace(0.01, 0.99, 199))


def brute(scores, ys, grid):
    best, bf = None, -1.0
    P = sum(ys)
    for k, t in enumerate(grid):
        pred = [s >= t for s in scores]
        tp = sum(1 for p, y in zip(pred, ys) if p and y)
        pp = sum(pred)
        f1 = 2 * tp / (pp + P) if pp + P else 0.0
        if f1 > bf:
            best, bf = k, f1
    return best, bf


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 1)), min_size=1, max_size=60))
def test_adaptive_sweep_equals_brute_force(spark, pairs):
    scores = [s / 7.0 - 1.0 for s, _ in pairs]  # many ties
    ys = [y for _, y in pairs]
    df = spark.createDataFrame(list(zip(scores, ys)), "score double, y_true int")
    got = TH.best_threshold_adaptive(df).first()
    grid = np.linspace(min(scores), max(scores), 200)
    k, f1 = brute(scores, ys, grid)
    assert got.k == k and got.f1 == pytest.approx(f1, abs=1e-15)
    assert got.threshold == grid[k]


def test_fixed_sweep_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    scores = np.round(rng.random(500), 3).tolist()
    ys = (rng.random(500) < 0.3).astype(int).tolist()
    df = spark.createDataFrame(list(zip(scores, ys)), "prob_pos double, y_true int")
    got = TH.best_threshold_fixed(df).first()
    k, f1 = brute(scores, ys, np.linspace(0.01, 0.99, 199))
    assert got.k == k and got.f1 == pytest.approx(f1, abs=1e-15)


def test_confusion_sums_and_report(spark):
    df = confusion_df(spark, 5, 3, 2, 10)
    c = E.confusion_counts(df).first()
    assert c.tn + c.fp + c.fn + c.tp == 20
    rep = {r.label: r for r in E.classification_report(df).collect()}
    assert rep["accuracy"].f1_score == 15 / 20 and rep["1"].support == 7 and rep["0"].support == 13
    assert rep["macro avg"].precision == pytest.approx((10 / 12 + 5 / 8) / 2)


def test_top_mistakes_order_sign_and_plan(spark):
    rows = [(i, 0, 1, i / 10) for i in range(10)] + [(100 + i, 1, 0, i / 10) for i in range(10)]
    df = spark.createDataFrame(rows, "record_id int, y_true int, y_pred int, score double")
    fp = E.top_mistakes(df, "fp", k=3)
    assert [r.record_id for r in fp.collect()] == [9, 8, 7]
    fn = E.top_mistakes(df, "fn", k=3).collect()
    assert [r.record_id for r in fn] == [100, 101, 102] and fn[0].mistake_strength == -0.0
    assert "TakeOrderedAndProject" in fp._jdf.queryExecution().executedPlan().toString()


def test_score_column_resolution(spark):
    df = spark.createDataFrame([(1, 0.3)], "y_true int, prob_pos double")
    assert E.resolve_score_col(df) == "prob_pos"
    with pytest.raises(ValueError):
        E.resolve_score_col(df, "score")
    with pytest.raises(ValueError):
        E.resolve_score_col(df.drop("prob_pos"))


def test_leaderboard_ties_keep_earlier(spark):
    c = spark.createDataFrame([("a", 0, 0.5, 0.1), ("b", 1, 0.7, 0.2), ("c", 2, 0.7, 0.3)],
                              "model string, position int, f1 double, threshold double")
    assert [r.model for r in E.leaderboard(c).orderBy("rank").collect()] == ["b", "c", "a"]
    h = spark.createDataFrame([(0, 0.4), (1, 0.6), (2, 0.6)], "step int, f1_pos double")
    assert E.best_checkpoint(h).first().step == 1


def test_top_repeated_texts_ties_by_text(spark):
    rows = [(0, "b")] * 3 + [(0, "a")] * 3 + [(1, "c")] * 3 + [(0, "z" * 100 + "1")] + [(0, "z" * 100 + "0")]
    df = spark.createDataFrame(rows, "binary_label int, text string")
    got = [(r.binary_label, r.text, r.frequency) for r in P.top_repeated_texts(df, 4).collect()]
    assert got == [(0, "a", 3), (0, "b", 3), (1, "c", 3), (0, "z" * 100 + "0", 1)]
