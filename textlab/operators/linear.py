"""Class weights, linear decision scores and the rows and certificate of a linear fit."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_root


def class_weights(df: DataFrame, label: str = "binary_label") -> DataFrame:
    """Balanced weights n / (2 * max(count, 1)) for labels 0 and 1.

    One aggregation; the two output rows are built from its single row.
    """
    y = F.col(label)
    c = df.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 0).alias("c0"), F.count_if(y == 1).alias("c1")
    )

    def row(lab, cnt):
        w = F.col("n").cast("double") / (F.lit(2.0) * F.greatest(F.col(cnt), F.lit(1)).cast("double"))
        return F.struct(F.lit(lab).alias("label"), F.col(cnt).cast("bigint").alias("count"), w.alias("weight"))

    return c.select(F.inline(F.array(row(0, "c0"), row(1, "c1"))))


# ---------------------------------------------------------------------------
# M3: linear decision score
# ---------------------------------------------------------------------------
# A coefficient table of at most so many entries (16 bytes each) is sent to the tasks.
COEF_BROADCAST_MAX = 4_000_000


def decision_score(packed: DataFrame, coef: DataFrame, bias: float, carry=(), size: int | None = None,
                   out: str = "score", broadcast_max: int = COEF_BROADCAST_MAX) -> DataFrame:
    """(*carry, score): w.x + b for sparse rows, one row per input row (M3).

    ``coef`` is an (idx, coef) table of ``size`` entries (counted if not
    given); idx without an entry count as 0.  Up to ``broadcast_max`` entries
    the product is taken inside the row and nothing is shuffled; beyond, the
    rows are written out, numbered and their entries joined.  A row with no
    known term scores ``b``.
    """
    size = coef.count() if size is None else size
    rows = packed.select(*carry, "idx", "val")
    if size > broadcast_max:
        return _decision_joined(rows, coef, bias, carry, out)
    table = coef.select("idx", "coef").toArrow()
    w = np.zeros(int(table["idx"].to_numpy().max(initial=-1)) + 1)
    w[table["idx"].to_numpy()] = table["coef"].to_numpy()
    shared = packed.sparkSession.sparkContext.broadcast(w)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            row, idx, val = _entries(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1))
            inside = idx < len(w)
            s = np.bincount(row[inside], val[inside] * w[idx[inside]], minlength=batch.num_rows) + bias
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(s)], [*batch.schema.names[:-2], out])

    schema = T.StructType(rows.schema.fields[:-2] + [T.StructField(out, T.DoubleType())])
    return rows.mapInArrow(work, schema)


def _decision_joined(rows: DataFrame, coef: DataFrame, bias: float, carry, out: str) -> DataFrame:
    checkpoint_root(rows.sparkSession)
    fixed = rows.checkpoint().withColumn("_row", F.monotonically_increasing_id())
    entries = fixed.select("_row", F.inline(F.arrays_zip("idx", "val")))
    sums = entries.join(coef.select("idx", "coef"), "idx").groupBy("_row").agg(F.sum(F.col("val") * F.col("coef")).alias(out))
    total = (F.coalesce(F.col(out), F.lit(0.0)) + F.lit(float(bias))).alias(out)
    return fixed.join(sums, "_row", "left").select(*carry, total)


def decision_scores(packed: DataFrame, coefs: DataFrame, biases: list[float], carry=(), out: str = "scores",
                    broadcast_max: int = COEF_BROADCAST_MAX) -> DataFrame:
    """(*carry, scores array): the decision values of several models in one pass over sparse rows.

    ``coefs`` is an (idx, coefs array) table with one coefficient per model.  Up
    to ``broadcast_max`` coefficients the product is taken inside the row;
    beyond, entries are joined under row numbers as in ``decision_score``.
    """
    rows, width = packed.select(*carry, "idx", "val"), len(biases)
    if coefs.count() * width > broadcast_max:
        return _decisions_joined(rows, coefs, biases, carry, out)
    table = coefs.toArrow()
    idx = table["idx"].to_numpy()
    w = np.zeros((int(idx.max(initial=-1)) + 1, width))
    flat = table["coefs"].combine_chunks()
    w[idx] = flat.flatten().to_numpy().reshape(-1, width)
    shared = packed.sparkSession.sparkContext.broadcast((w, np.array(biases)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, biases = shared.value
        for batch in batches:
            row, idx, val = _entries(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1))
            known = idx < len(w)
            row, idx, val = row[known], idx[known], val[known]
            s = np.stack([np.bincount(row, val * w[idx, k], minlength=batch.num_rows) for k in range(len(biases))], 1) + biases
            edge = np.arange(batch.num_rows + 1, dtype=np.int32) * len(biases)
            lists = pa.ListArray.from_arrays(pa.array(edge), pa.array(s.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], lists], [*batch.schema.names[:-2], out])

    schema = T.StructType(rows.schema.fields[:-2] + [T.StructField(out, T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(work, schema)


def _decisions_joined(rows: DataFrame, coefs: DataFrame, biases: list[float], carry, out: str) -> DataFrame:
    checkpoint_root(rows.sparkSession)
    fixed = rows.checkpoint().withColumn("_row", F.monotonically_increasing_id())
    entries = fixed.select("_row", F.inline(F.arrays_zip("idx", "val"))).join(coefs, "idx")
    sums = entries.groupBy("_row").agg(*(F.sum(F.col("val") * F.col("coefs")[k]).alias(f"_{k}") for k in range(len(biases))))
    total = F.array(*(F.coalesce(F.col(f"_{k}"), F.lit(0.0)) + F.lit(float(b)) for k, b in enumerate(biases))).alias(out)
    return fixed.join(sums, "_row", "left").select(*carry, total)


def _entries(idx: pa.Array, val: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, idx, val) of a batch's sparse rows."""
    a, b = idx.offsets.to_numpy(), val.offsets.to_numpy()
    flat_i = idx.values.to_numpy(zero_copy_only=False)[a[0] : a[-1]]
    flat_v = val.values.to_numpy(zero_copy_only=False)[b[0] : b[-1]]
    return np.repeat(np.arange(len(a) - 1), np.diff(a)), flat_i, flat_v


# ---------------------------------------------------------------------------
# M1 / M2: class-weighted L2 linear models, bias regularised
# ---------------------------------------------------------------------------
# Model hyper-parameters of the reference's two candidates.
LOGREG_C = 2.0
SVM_C = 1.0


def training_rows(packed: DataFrame, weights: DataFrame, label: str = "binary_label", max_rows: int | None = None) -> DataFrame:
    """Sparse rows + class weight per row, materialised in the shared checkpoint folder.

    All rows, whatever their number; only a caller that names ``max_rows`` gets
    about so many (those with the smallest hashes of their features), and no
    query does.

    Checkpointing cuts the lineage the solver re-reads at every pass, so a
    lost executor costs one partition re-read, not the feature pipeline.
    """
    w = F.broadcast(weights.select(F.col("label").alias(label), F.col("weight").alias("s")))  # two rows
    rows = packed.join(w, label).select(F.col(label).cast("int").alias("y"), "s", "idx", "val")
    checkpoint_root(packed.sparkSession)
    rows = rows.checkpoint()
    if max_rows is not None and (n := rows.count()) > max_rows:
        part = F.pmod(F.xxhash64("y", "idx"), F.lit(1 << 30)) < F.lit(int((1 << 30) * max_rows / n))
        rows = rows.filter(part)
    return rows


def gradient_norm(rows: DataFrame, coef: DataFrame, bias: float, loss: str, C: float) -> DataFrame:
    """One row: the norm of the objective's gradient at (coef, bias), by joins and sums alone (no solver code).

    The objective is strongly convex with modulus 1, so the distance to its
    optimum is at most this norm.
    """
    checkpoint_root(rows.sparkSession)
    fixed = rows.checkpoint().withColumn("_row", F.monotonically_increasing_id())
    entries = fixed.select("_row", F.inline(F.arrays_zip("idx", "val")))
    margin = entries.join(coef, "idx").groupBy("_row").agg(F.sum(F.col("val") * F.col("coef")).alias("m"))
    sign = 2.0 * F.col("y") - 1.0
    z = sign * (F.coalesce("m", F.lit(0.0)) + F.lit(bias))
    slope = -sign / (1.0 + F.exp(z)) if loss == "logistic" else -2.0 * sign * F.greatest(F.lit(0.0), 1.0 - z)
    # rows meet their margins packed, so their entries are neither exchanged nor sorted for it
    d = fixed.join(margin, "_row", "left").withColumn("d", F.lit(C) * F.col("s") * slope)
    data = d.select("d", F.inline(F.arrays_zip("idx", "val"))).groupBy("idx").agg(F.sum(F.col("val") * F.col("d")).alias("g"))
    whole = coef.join(data, "idx", "left").agg(F.sum(F.pow(F.col("coef") + F.coalesce("g", F.lit(0.0)), 2)).alias("w2"))
    of_bias = d.agg(F.sum("d").alias("b"))
    return whole.crossJoin(F.broadcast(of_bias)).select(F.sqrt(F.col("w2") + F.pow(F.col("b") + F.lit(bias), 2)).alias("grad_norm"))
