"""Dense row numbers without a single-partition window.

``row_number()`` over an unpartitioned window pulls every row into one task.
Here the data are range-sorted, each row gets (partition id, monotonically
increasing id), the sorted table is checkpointed to the shared folder so both
the counting and the numbering read the same materialised rows, and a
one-row-per-partition offset table (bounded by the partition count) is
broadcast back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def dense_index(df: DataFrame, order_by: list, name: str = "idx", materialize: bool = True) -> DataFrame:
    """Add ``name`` = 0..n-1 following ``order_by`` (ties broken by the sort's partitioning)."""
    s = df.orderBy(*order_by).withColumns({
        "_pid": F.spark_partition_id(), "_mono": F.monotonically_increasing_id(),
    })
    if materialize:
        checkpoint_root(df.sparkSession)
        s = s.checkpoint(eager=True)
    return _number(s, name)


def number_by_position(df: DataFrame, position: str, name: str = "line") -> DataFrame:
    """0..n-1 in the order of a (file, block, row) position struct, without gaps whatever rows were filtered out."""
    return dense_index(df, [f"{position}.file", f"{position}.block", f"{position}.row"], name)


def _number(s: DataFrame, name: str) -> DataFrame:
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_m0"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = s.join(F.broadcast(offs), "_pid").withColumn(
        name, F.col("_off") + F.col("_mono") - F.col("_m0")
    )
    return out.drop("_pid", "_mono", "_n", "_m0", "_off")
