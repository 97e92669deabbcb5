"""Windows of a fixed width that also start earlier: what suffix-array and substring dedup share.

A method gives, for each document, its windows in segments: neighbouring windows
that hang on one anchor.  The anchor is chosen from a window's content alone, so
equal windows hang on equal anchors (`key`) at equal distances.  Segments of one
key that agree in all their content (`ctx`) agree in all their windows: all but
the first are covered as a whole.  Where a key has segments of different content,
the first of each is taken apart into its windows, which are compared one by one.

Documents are ordered by (d, tag, tag2): d is the id, null ids first as the
smallest long, and the tags, wide hashes of the text, tell texts apart under one
id.  A place is a document and the number of a unit in it, `at`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, keyed_texts, stash, strings
from .words import U, mix

NULL_ID = -(1 << 63)
#: What names a document, and a place in one; also their orders.
DOC = ["d", "tag", "tag2"]
PLACE = [*DOC, "at"]
#: Rows of segments that a task gathers before it drops those that repeat among them.
GATHER = 400_000
#: Segments of one anchor hold at most so many windows (one byte of ctx says how many).
MOST = 256

#: segments(bytes, offsets) -> (document, first window, windows, key, ctx), in document and position order
Segments = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, ...]]


def ordered_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return keyed_texts(docs, id_col, text_col).withColumn("d", F.coalesce("doc_id", F.lit(NULL_ID)))


def pack_segments(anchor: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of windows that hang on one anchor; `first` are the windows' numbers."""
    n = len(anchor)
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (first[1:] != first[:-1] + 1)
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, n))
    if len(size) and size.max() > MOST:
        more = np.concatenate([np.arange(a, a + s, MOST) for a, s in zip(at[size > MOST], size[size > MOST], strict=True)])
        at = np.unique(np.concatenate([at, more]))
        size = np.diff(np.append(at, n))
    return at, size


def segment_rows(texts: DataFrame, segments: Segments, width: int) -> DataFrame:
    """(key, d, tag, tag2, at, ctx, known): one row per segment.

    Segments that repeat earlier ones within a task are joined into covers:
    `known` rows, whose key is a number to deal them evenly and whose ctx is
    the cover's length.
    """

    def resolve(rows: list[tuple[np.ndarray, ...]], docs: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, doc, first, ctx = (np.concatenate([r[i] for r in rows]) for i in range(4))
        name = [np.concatenate([x[i] for x in docs]) for i in range(3)]
        # documents by their rank here; rows of one document have one rank
        by = np.lexsort(name[::-1])
        new = np.ones(len(by), bool)
        new[1:] = np.any([c[by][1:] != c[by][:-1] for c in name], axis=0)
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(new) - 1
        name = [c[by[new]] for c in name]
        at = (rank[doc] << 32) | first
        order = np.lexsort((at, ctx, key))
        k, c = key[order], ctx[order]
        again = np.zeros(len(order), bool)
        again[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        dup = np.zeros(len(order), bool)
        dup[order] = again
        # the same place twice is a row listed twice, not a repeat:
        # a twin of the first is dropped with it as first; a twin of a repeat is a repeat
        first_twin = np.zeros(len(order), bool)
        lead = np.maximum.accumulate(np.where(~again, np.arange(len(order)), 0))
        first_twin[order] = again & (at[order] == at[order][lead])
        keep, cover = ~dup, dup & ~first_twin
        ca = at[cover]
        ce = ca + (ctx[cover] & 0xFF) + width
        by = np.argsort(ca, kind="stable")
        ca, ce = ca[by], ce[by]
        new = np.ones(len(ca), bool)
        new[1:] = ca[1:] > ce[:-1]
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(ca)) - 1
        cs, cl = ca[starts], (ce[ends] - ca[starts]) if len(starts) else ca[:0]
        places = np.concatenate([at[keep], cs])
        at, place = places & 0xFFFFFFFF, [c[places >> 32] for c in name]
        n = int(keep.sum())
        spread = (place[0][n:] ^ place[1][n:]) * 1_000_003 + at[n:]
        known = np.concatenate([np.zeros(n, bool), np.ones(len(starts), bool)])
        cols = [np.concatenate([key[keep], spread]), *place, at, np.concatenate([ctx[keep], cl])]
        return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in cols), pa.array(known)], ["key", *PLACE, "ctx", "known"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, docs, n, m = [], [], 0, 0
        for batch in batches:
            name = [batch.column(i).to_numpy() for i in range(3)]
            for a, b, buf, off in chunks(batch.column(3)):
                doc, first, size, key, ctx = segments(buf, off)
                docs.append(tuple(c[a:b] for c in name))
                rows.append((key.view(np.int64), m + doc, first, ((ctx & ~U(0xFF)) | (size - 1).astype(np.uint64)).view(np.int64)))
                n, m = n + len(doc), m + b - a
                if n >= GATHER:
                    yield resolve(rows, docs)
                    rows, docs, n, m = [], [], 0, 0
        if n:
            yield resolve(rows, docs)

    schema = "key long, d long, tag long, tag2 long, at long, ctx long, known boolean"
    return texts.select(*DOC, "text").mapInArrow(work, schema)


def by_windows(rows: DataFrame) -> DataFrame:
    """(key, d, tag, tag2, at, ctx, known, kind) of the segments that matter: kind 0 covers, kind 1 has to be taken apart."""
    of_key = Window.partitionBy("key").orderBy("ctx", *PLACE).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_ctx = Window.partitionBy("key", "ctx").orderBy(*PLACE)
    seen = rows.select(
        "*", F.min("ctx").over(of_key).alias("least"), F.max("ctx").over(of_key).alias("most"),
        F.rank().over(of_ctx).alias("place"),
    )
    cover = F.col("known") | (F.col("place") > 1)
    kind = F.when(cover, F.lit(0)).when(F.col("least") != F.col("most"), F.lit(1))
    return seen.select("key", *PLACE, "ctx", "known", kind.alias("kind")).filter("kind is not null")


def with_text(texts: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents joined to what was gathered for them under (d, tag, tag2)."""
    return texts.join(lists, DOC, how)


def apart(texts: DataFrame, marks: DataFrame, windows: Callable[[bytes, np.ndarray], np.ndarray]) -> DataFrame:
    """(d, tag, tag2, at) of the single windows that also start earlier, among those of the segments to be taken apart.

    `windows(text, numbers)` gives the hashes of a document's windows.
    """
    lists = (
        marks.filter("kind = 1")
        .select(*DOC, F.col("at").alias("first"), F.col("ctx").bitwiseAND(F.lit(255)).alias("more"), "key")
        .groupBy(*DOC)
        .agg(F.collect_set(F.struct("first", "more", "key")).alias("parts"))  # of one document
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["window", *PLACE]
        for batch in batches:
            buf, off = strings(batch.column(3))
            rows, n = [], 0
            for i in range(batch.num_rows):
                parts = batch.column(4)[i].values
                first, more, key = (parts.field(j).to_numpy() for j in range(3))
                size = more + 1
                at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
                h = windows(buf[off[i] : off[i + 1]], at)
                doc = (np.full(len(at), batch.column(j)[i].as_py(), np.int64) for j in range(3))
                h = mix(h + np.repeat(key.view(np.uint64), size), 47)  # windows of different anchors differ
                rows.append((h.view(np.int64), *doc, at))
                n += len(at)
                if n >= GATHER or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows, strict=True)], names)
                    rows, n = [], 0

    # the same columns as the last join with the texts takes, so that both share one shuffle of them
    joined = with_text(texts, lists, "inner").select(*DOC, "text", "parts", "doc_id")
    single = joined.mapInArrow(work, "window long, d long, tag long, tag2 long, at long")
    order = Window.partitionBy("window").orderBy(*PLACE)
    return single.withColumn("place", F.rank().over(order)).filter("place > 1").select(*PLACE)


def covers(texts: DataFrame, marks: DataFrame, width: int, windows: Callable[[bytes, np.ndarray], np.ndarray]) -> DataFrame:
    """(d, tag, tag2, spans): the covered stretches of each document that has some, as (start, end) structs in any order."""
    size = F.when(F.col("known"), F.col("ctx")).otherwise(F.col("ctx").bitwiseAND(F.lit(255)) + width)
    whole = marks.filter("kind = 0").select(*PLACE, size.alias("size"))
    single = apart(texts, marks, windows).select(*PLACE, F.lit(width).cast("long").alias("size"))
    return (
        whole.unionByName(single)
        .select(*DOC, F.struct(F.col("at").alias("start"), (F.col("at") + F.col("size")).alias("end")).alias("span"))
        .groupBy(*DOC)
        .agg(F.collect_set("span").alias("spans"))  # of one document
    )


def merged(spans: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """Sorted, disjoint and not touching (starts, ends)."""
    if not spans.is_valid or len(spans.values) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, end = (spans.values.field(j).to_numpy() for j in range(2))
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return start[at], reach[np.append(at[1:], len(start)) - 1]


def resolved(
    docs: DataFrame,
    segments: Segments,
    classify: Callable[[DataFrame], DataFrame],
    windows: Callable[[bytes, np.ndarray], np.ndarray],
    width: int,
    id_col: str,
    text_col: str,
) -> DataFrame:
    """(doc_id, text, spans) of all documents, spans null where nothing is covered."""
    texts = ordered_texts(docs, id_col, text_col)
    marks = stash(classify(segment_rows(texts, segments, width)), "repeats")
    found = covers(texts, marks, width, windows)
    return with_text(texts, found, "left").select("doc_id", "text", "spans")
