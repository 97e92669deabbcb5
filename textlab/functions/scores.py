"""Score / outcome column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def softmax2(l0, l1) -> Column:
    """Positive-class probability of a two-logit softmax, max-subtracted."""
    l0, l1 = _col(l0), _col(l1)
    m = F.greatest(l0, l1)
    e0, e1 = F.exp(l0 - m), F.exp(l1 - m)
    return e1 / (e0 + e1)


def apply_threshold(score, threshold) -> Column:
    """`score >= t` as 0/1 (F11).  ``threshold`` may be a float or a Column."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (_col(score) >= t).cast("int")


def mistake_strength(score, y_pred="y_pred") -> Column:
    """Confidence of a mistake: +score for a false positive, -score for a false negative."""
    return F.when(_col(y_pred) == 1, _col(score)).otherwise(-_col(score))


def outcome_group(y_true="y_true", y_pred="y_pred") -> Column:
    """`true=<t>,pred=<p>`."""
    return F.concat(
        F.lit("true="), _col(y_true).cast("string"), F.lit(",pred="), _col(y_pred).cast("string")
    )
