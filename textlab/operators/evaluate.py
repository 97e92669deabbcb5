"""Evaluation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scores import apply_threshold, mistake_strength

# Preferred score columns, in order, and the mistake table size.
SCORE_COLUMNS = ("score", "prob_pos")
TOP_MISTAKES = 50


def _safe_div(num, den) -> F.Column:
    """num / den, 0 when den is 0 (zero-division -> 0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def resolve_score_col(df: DataFrame, name: str = "auto") -> str:
    """`auto` -> first of score / prob_pos present; a named column must exist."""
    if name == "auto":
        for c in SCORE_COLUMNS:
            if c in df.columns:
                return c
        raise ValueError(f"none of the columns {', '.join(SCORE_COLUMNS)} is there")
    if name not in df.columns:
        raise ValueError(f"there is no column {name!r} to take scores from")
    return name


def mistakes(df: DataFrame, kind: str, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """False positives (`fp`) or false negatives (`fn`) (P5)."""
    t, p = F.col(y_true), F.col(y_pred)
    if kind == "fp":
        return df.filter((t == 0) & (p == 1))
    if kind == "fn":
        return df.filter((t == 1) & (p == 0))
    raise ValueError(f"kind must be 'fp' or 'fn', got {kind!r}")


def top_mistakes(df: DataFrame, kind: str, score: str = "auto", k: int = TOP_MISTAKES,
                 key: str = "record_id") -> DataFrame:
    """The k most confident mistakes, strength descending, ties by key.

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each partition
    keeps k rows, no full sort.
    """
    s = resolve_score_col(df, score)
    m = mistakes(df, kind).withColumn("mistake_strength", mistake_strength(F.col(s), F.col("y_pred")))
    return m.orderBy(F.desc("mistake_strength"), F.col(key)).limit(k)


def confusion_counts(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by=None) -> DataFrame:
    """TN, FP, FN, TP in one pass."""
    t, p = F.col(y_true), F.col(y_pred)
    aggs = [
        F.count_if((t == 0) & (p == 0)).cast("bigint").alias("tn"),
        F.count_if((t == 0) & (p == 1)).cast("bigint").alias("fp"),
        F.count_if((t == 1) & (p == 0)).cast("bigint").alias("fn"),
        F.count_if((t == 1) & (p == 1)).cast("bigint").alias("tp"),
    ]
    return (df.groupBy(*by) if by else df).agg(*aggs)


def metrics_from_counts(counts: DataFrame) -> DataFrame:
    """Positive-class precision / recall / F1 with zero division -> 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": _safe_div(tp, tp + fp),
        "recall": _safe_div(tp, tp + fn),
        "f1": _safe_div(2 * tp, 2 * tp + fp + fn),
    })


def binary_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred", by=None) -> DataFrame:
    """A8 + A9 in one aggregation."""
    return metrics_from_counts(confusion_counts(df, y_true, y_pred, by))


def classification_report(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """Per-class P/R/F1/support, accuracy, macro and weighted averages (A10).

    One aggregation; the five report rows are built from its single row.
    """
    c = confusion_counts(df, y_true, y_pred)
    tn, fp, fn, tp = (F.col(n) for n in ("tn", "fp", "fn", "tp"))
    s0, s1 = tn + fp, fn + tp
    n = s0 + s1
    p0, r0, f0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(2 * tn, 2 * tn + fn + fp)
    p1, r1, f1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(2 * tp, 2 * tp + fp + fn)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("bigint").alias("support"))

    def wavg(a, b):
        return _safe_div(s0.cast("double") * a + s1.cast("double") * b, n)

    null = F.lit(None).cast("double")
    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", null, null, _safe_div(tn + tp, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n),
    )
    return c.select(F.inline(rows))


def metrics_at(df: DataFrame, threshold: float = 0.5, prob: str = "prob_pos", y_true: str = "y_true") -> DataFrame:
    """F1 / precision / recall of the positive class at a fixed threshold."""
    pred = df.withColumn("_pred", apply_threshold(F.col(prob), threshold))
    return binary_metrics(pred, y_true, "_pred").select(
        F.col("f1").alias("f1_pos"), F.col("precision").alias("precision_pos"), F.col("recall").alias("recall_pos")
    )


def pred_positive_rate(df: DataFrame, by: str = "split", y_pred: str = "y_pred") -> DataFrame:
    """Share of predicted positives per group."""
    return df.groupBy(by).agg(F.avg(F.col(y_pred).cast("double")).alias("positive_rate_pred"))


def local_evaluation(df: DataFrame, score: str = "auto", y_true: str = "y_true", y_pred: str = "y_pred") -> DataFrame:
    """One summary row: F1, precision, recall, #FP, #FN, score column."""
    s = resolve_score_col(df, score)
    return binary_metrics(df, y_true, y_pred).select(
        "f1", "precision", "recall",
        F.col("fp").alias("false_positives"), F.col("fn").alias("false_negatives"),
        F.lit(s).alias("score_column"),
    )


def category_recall(df: DataFrame, label_vector: str = "label_raw", y_pred: str = "y_pred") -> DataFrame:
    """Recall per category of the label vector, over rows where that category is 1."""
    vec = F.from_json(F.col(label_vector), "array<int>")
    ex = df.select(F.posexplode(vec).alias("category", "_v"), F.col(y_pred))
    return ex.filter("_v = 1").groupBy("category").agg(
        F.count(F.lit(1)).cast("bigint").alias("support"),
        F.avg(F.col(y_pred).cast("double")).alias("recall"),
    )


def weighted_log_loss(df: DataFrame, weights: DataFrame, l0: str = "l0", l1: str = "l1",
                      y_true: str = "y_true") -> DataFrame:
    """Class-weighted mean cross-entropy sum(w*l)/sum(w) of two-logit rows.

    ``weights`` is the two-row (label, weight) table of ``class_weights``.
    """
    w = F.broadcast(weights.select(F.col("label").alias(y_true), "weight"))
    a, b = F.col(l0), F.col(l1)
    m = F.greatest(a, b)
    lse = m + F.log(F.exp(a - m) + F.exp(b - m))
    nll = lse - F.when(F.col(y_true) == 1, b).otherwise(a)
    j = df.join(w, y_true)
    return j.agg(
        (F.sum(F.col("weight") * nll) / F.sum("weight")).alias("loss"),
        F.sum("weight").alias("weight_sum"),
    )


def leaderboard(candidates: DataFrame, metric: str = "f1", position: str = "position") -> DataFrame:
    """Candidates by metric descending; ties keep the earlier one; rank 1 is best.

    The candidate table has one row per model, so the ranking window is tiny.
    """
    from pyspark.sql import Window

    w = Window.orderBy(F.desc(metric), F.col(position))
    return candidates.withColumn("rank", F.row_number().over(w).cast("int"))


def step_metrics(scores: DataFrame, label: str, col: str = "scores", threshold: float = 0.0) -> DataFrame:
    """(step, tp, fp, fn, precision_pos, recall_pos, f1_pos) of every model's scores in an array column.

    One pass; the counts are summed per step on the map side, so the exchange has a row per task and step.
    """
    each = scores.select(F.col(label).alias("_y"), F.posexplode(col).alias("step", "_s"))
    hit = F.col("_s") >= F.lit(float(threshold))
    counts = each.groupBy("step").agg(
        F.count_if(hit & (F.col("_y") == 1)).alias("tp"), F.count_if(hit & (F.col("_y") == 0)).alias("fp"),
        F.count_if(~hit & (F.col("_y") == 1)).alias("fn"),
    )
    share = lambda over: F.when(over > 0, F.col("tp") / over).otherwise(F.lit(0.0))
    return counts.select(
        "step", "tp", "fp", "fn", share(F.col("tp") + F.col("fp")).alias("precision_pos"), share(F.col("tp") + F.col("fn")).alias("recall_pos"),
        share(F.col("tp") + (F.col("fp") + F.col("fn")) / 2).alias("f1_pos"),
    )


def best_checkpoint(history: DataFrame, metric: str = "f1_pos", step: str = "step") -> DataFrame:
    """The evaluation step with the highest metric; the earliest wins ties."""
    key = F.struct(F.col(metric), (-F.col(step)).alias("_neg_step"))
    cols = history.columns
    return history.agg(F.max_by(F.struct(*cols), key).alias("_b")).select("_b.*")
