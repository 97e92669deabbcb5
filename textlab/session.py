"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "textlab") -> SparkSession:
    """A local session configured the way the library expects (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TEXTLAB_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session.  On a cluster it must name a shared
    filesystem: a folder local to the driver would not be visible to the
    executors, so an unset value is an error there.  Only a local-mode
    session (tests, the bench) with no setting gets a folder of its own, and
    it is recorded on the session so every later call agrees.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a folder on a filesystem shared by all "
                "executors (it holds the checkpointed training rows and vocabulary)"
            )
        root = tempfile.mkdtemp(prefix="textlab-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder; what is written there goes when the driver's program ends."""
    path = f"{checkpoint_root(spark)}/textlab-{name}-{uuid.uuid4().hex[:12]}"
    _scratch.append((spark, path))
    return path


def observed_write(df: DataFrame, path: str, **metrics: Column) -> dict:
    """Write ``df`` as Parquet and return aggregates of it that are taken in the same pass."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(name) for name, c in metrics.items())).write.mode("overwrite").parquet(path)
    return seen.get


def stored(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``df`` written to the shared scratch folder, and aggregates observed in that write."""
    path = scratch_path(df.sparkSession, name)
    seen = observed_write(df, path, **metrics)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


@atexit.register
def drop_scratch() -> None:
    """Delete the scratch tables of this program. Where the JVM is gone already, they stay for whoever empties the folder."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)
        except Exception:  # noqa: BLE001  the gateway may be closed
            return
