"""Ingestion operators: parse, validate, dedupe, join, union."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import (
    SEVERITY_MAX, SEVERITY_MIN, article_id, binarize_label, decimal, label_raw, severity_to_binary, to_label,
)
from ..functions.text import clean_text
from ..session import checkpoint_root

# Largest split table, in measured bytes, that is broadcast to the corpus scan in
# ``labelled_split``; beyond it both sides are shuffled on the key.
SPLIT_BROADCAST_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64
# A corpus key with more rows than this is joined apart, spread over buckets
# of about this many rows.
HOT_KEY_ROWS = 1_000_000

# Bits a key and hashes of the Bloom filter of split keys, its largest size, and the bytes that are joined at a time.
BLOOM_BITS = 10
BLOOM_HASHES = 6
BLOOM_MAX_BYTES = 64 * 1024 * 1024
BLOOM_PIECE = 1 << 20


def _full_digits(c: str) -> F.Column:
    return F.col(c).rlike(r"^[0-9]+\z")


def valid_corpus(df: DataFrame) -> DataFrame:
    """Rows with a numeric id, an `@@<digits>` article and a label in [0, 4]."""
    lab = decimal("raw_label")
    return df.filter(
        _full_digits("record_id")
        & F.col("article_id").rlike(r"^@@[0-9]+\z")
        & lab.isNotNull()
        & lab.between(SEVERITY_MIN, SEVERITY_MAX)
    )


def valid_test(df: DataFrame) -> DataFrame:
    """Rows with a `t_<digits>` sample id and an `@@<digits>` article."""
    return df.filter(F.col("sample_id").rlike(r"^t_[0-9]+\z") & F.col("article_id").rlike(r"^@@[0-9]+\z"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when ``df`` is empty (P3).  A limit-1 job that takes one partition first; ``isEmpty`` may start them all."""
    if not df.select(F.lit(1)).take(1):
        raise ValueError(f"{what}: no valid record is left after parsing")
    return df


def parse_corpus(raw: DataFrame, check: bool = True) -> DataFrame:
    """Raw corpus strings -> typed, cleaned corpus."""
    df = valid_corpus(raw)
    if check:
        require_rows(df, "corpus")
    lab = to_label("raw_label")
    return df.select(
        F.col("record_id").cast("bigint").alias("record_id"),
        article_id("article_id").alias("article_id"),
        "keyword", "country",
        clean_text("text").alias("text"),
        lab.alias("raw_label"),
        severity_to_binary(lab).alias("binary_label_raw"),
        "_ord",
    )


def parse_test(raw: DataFrame, check: bool = True) -> DataFrame:
    """Raw test strings -> typed, cleaned test table."""
    df = valid_test(raw)
    if check:
        require_rows(df, "test")
    return df.select(
        "sample_id",
        article_id("article_id").alias("article_id"),
        "keyword", "country",
        clean_text("text").alias("text"),
        "_ord",
    )


def dedupe_keep_last(df: DataFrame, key: str, order: str = "_ord") -> DataFrame:
    """One row per key: the one that comes last in file order.

    ``max_by`` is a declarative aggregate, so Spark combines map-side before
    the shuffle and a hot key never gathers its rows in one task.
    """
    others = [c for c in df.columns if c != key]
    picked = F.max_by(F.struct(*others), F.col(order)).alias("_last")
    return df.groupBy(key).agg(picked).select(key, "_last.*")


def parse_split(raw: DataFrame) -> DataFrame:
    """Split rows -> (record_id, binary_label, label_raw), last row per id kept."""
    # an id that is no number is an error whatever the session's ANSI setting
    number = F.trim("par_id").try_cast("bigint")
    bad = F.raise_error(F.concat(F.lit("split row with an id that is not a number: "), F.coalesce("par_id", F.lit("null"))))
    typed = raw.select(
        F.when(number.isNull(), bad.cast("bigint")).otherwise(number).alias("record_id"),
        binarize_label("label").alias("binary_label"),
        label_raw("label").alias("label_raw"),
        "_ord",
    )
    return dedupe_keep_last(typed, "record_id")


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the table's values and a fixed part per row, by one aggregation."""
    texts = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, t in df.dtypes if t == "string"]
    row = sum(texts, F.lit(ROW_OVERHEAD + 8 * (len(df.columns) - len(texts)))).cast("bigint")
    return df.agg(F.sum(row)).first()[0] or 0


def labelled_split(split: DataFrame, corpus: DataFrame, key: str = "record_id",
                   broadcast_max_bytes: int = SPLIT_BROADCAST_MAX_BYTES) -> DataFrame:
    """split LEFT JOIN corpus on the key; duplicate corpus ids fan out.

    The corpus is the large side.  When the split's measured size is within
    the bound it is broadcast to the corpus scan (an inner join that never shuffles the
    corpus) and the unmatched split rows are added back with an anti join on
    the small matched-key set.  Otherwise a Bloom filter of the split's keys drops
    the corpus rows that no split row asks for in the scan, and what is left is
    shuffled on the key, with hot corpus keys split over buckets (``skew_safe_left_join``).
    """
    right = corpus.select(key, "article_id", "keyword", "country", "text")
    if not broadcast_max_bytes or measured_bytes(split) > broadcast_max_bytes:
        return skew_safe_left_join(split, bloom_filtered(right, split, key), key)
    matched = right.join(F.broadcast(split), key, "inner")
    unmatched = split.join(matched.select(key).distinct(), key, "left_anti")
    nulls = {c: F.lit(None).cast(t) for c, t in right.dtypes if c != key}
    return matched.unionByName(unmatched.withColumns(nulls)).select(*split.columns, *nulls)


def bloom_filtered(rows: DataFrame, keys: DataFrame, key: str, max_bytes: int = BLOOM_MAX_BYTES) -> DataFrame:
    """The rows whose key may be among ``keys``: all that are, and about one in a hundred of the others.

    Ten bits a key, up to ``max_bytes`` (beyond, more of the others pass).  Every
    task of ``keys`` sets its bits, pieces of them are joined on the executors,
    and the filter is sent to the scan of ``rows``, so what it drops is never
    shuffled; only the keys' hashes pass through Python there.
    """
    spark = rows.sparkSession
    n = keys.count()
    size = min(max_bytes, max(1024, 1 << math.ceil(math.log2(max(1, n) * BLOOM_BITS / 8))))  # bytes, a power of two below the bound

    def places(hashes: np.ndarray) -> list[np.ndarray]:
        low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
        return [(low + np.uint64(i) * high) % np.uint64(8 * size) for i in range(BLOOM_HASHES)]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(8 * size, bool) if size <= BLOOM_PIECE else None
        packed = np.zeros(size, np.uint8)
        for batch in batches:
            for at in places(batch.column(0).to_numpy().view(np.uint64)):
                if bits is not None:
                    bits[at] = True
                else:
                    np.bitwise_or.at(packed, at >> np.uint64(3), np.uint8(128) >> (at & np.uint64(7)).astype(np.uint8))
        packed = packed if bits is None else np.packbits(bits)
        pieces = [(i, packed[i * BLOOM_PIECE : (i + 1) * BLOOM_PIECE]) for i in range(-(-size // BLOOM_PIECE))]
        pieces = [(i, p.tobytes()) for i, p in pieces if p.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pieces], pa.int32()), pa.array([p for _, p in pieces], pa.binary())], ["piece", "bits"])

    def joint(group, table):
        both = np.bitwise_or.reduce([np.frombuffer(v.as_buffer(), np.uint8) for c in table["bits"].chunks for v in c])
        return pa.table({"piece": pa.array([group[0].as_py()], pa.int32()), "bits": pa.array([both.tobytes()], pa.binary())})

    hashed = F.xxhash64(F.col(key).cast("bigint"))
    schema = "piece int, bits binary"
    made = keys.filter(F.col(key).isNotNull()).select(hashed.alias("h")).mapInArrow(fill, schema).groupBy("piece").applyInArrow(joint, schema)
    bloom = np.zeros(size, np.uint8)
    for r in made.collect():  # max_bytes in all
        bloom[r["piece"] * BLOOM_PIECE : r["piece"] * BLOOM_PIECE + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    shared = spark.sparkContext.broadcast(bloom)

    @F.pandas_udf("boolean")
    def may_hold(h: pd.Series) -> pd.Series:
        found = np.ones(len(h), bool)
        for at in places(h.to_numpy().view(np.uint64)):
            found &= (shared.value[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1 == 1
        return pd.Series(found)

    return rows.filter(F.col(key).isNotNull()).filter(may_hold(hashed))


def skew_safe_left_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """left LEFT JOIN right on ``key`` when neither side can be broadcast.

    AQE can split only the left side of a left outer join, so a right-side
    key holding a large share of the rows would land in one task.  Keys with
    more than ``hot_rows`` right rows are found by one count combined
    map-side and kept as a table of at most |right| / hot_rows rows, which
    stays on the executors.  A hot key's right rows are dealt over
    ceil(n / hot_rows) buckets by their row id, and its left rows are copied
    once per bucket, so every bucket joins a slice of at most ~hot_rows rows.
    A hot key always has right rows, so for it the left join is an inner
    join; the other keys take the plain shuffled join.
    """
    out_cols = left.columns + [c for c in right.columns if c != key]
    buckets = F.ceil(F.col("_n") / F.lit(float(hot_rows))).cast("int")
    counts = right.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    checkpoint_root(left.sparkSession)
    hot = counts.select(key, buckets.alias("_b")).checkpoint()
    if hot.isEmpty():
        return left.join(right, key, "left").select(*out_cols)
    cold = left.join(hot, key, "left_anti").join(right.join(hot, key, "left_anti"), key, "left")
    # the bucket follows from the row's content, so a retried task deals its
    # rows to the same buckets; rows equal in all columns may share one
    salt = F.pmod(F.xxhash64(*[c for c in right.columns if c != key]), F.col("_b").cast("bigint")).cast("int")
    r_hot = right.join(hot, key, "inner").withColumn("_salt", salt).drop("_b")
    l_hot = left.join(hot, key, "inner").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).drop("_b")
    hot_joined = l_hot.join(r_hot, [key, "_salt"], "inner")
    return cold.select(*out_cols).unionByName(hot_joined.select(*out_cols))


def check_missing(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Missing-text counts per split after the join, one aggregation."""
    return df.groupBy(split_col).agg(
        F.count_if(F.col("text").isNull()).cast("bigint").alias("missing_text"),
        F.count(F.lit(1)).cast("bigint").alias("rows"),
    )


def raise_on_missing(df: DataFrame, split_col: str = "split") -> None:
    """Raise with every split's count when any text is missing after the join."""
    refuse_missing({r[split_col]: r["missing_text"] for r in check_missing(df, split_col).collect()})


def refuse_missing(missing: dict[str, int]) -> None:
    """Raise with the count of every split that has rows without a text."""
    bad = ", ".join(f"{name}_missing={n}" for name, n in missing.items() if n)
    if bad:
        raise ValueError(f"split rows without a text in the corpus: {bad}")


def union_splits(**splits: DataFrame) -> DataFrame:
    """Tag each split with its name and concatenate."""
    out = None
    for name, df in splits.items():
        tagged = df.withColumn("split", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
