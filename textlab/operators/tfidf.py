"""TF-IDF features (T4-T8): uni+bigrams, document-frequency vocabulary,
sublinear TF, smoothed IDF, L2 rows.

A document is a row.  Its terms are counted, weighted and normalised inside
the row, so rows that share a key stay apart and no text is shuffled: the
fit's only exchange carries packed counts of chunks, and a transform against
a vocabulary of checked size has none at all.  A larger vocabulary is looked up
by a shuffled join of (row, term, count) under a row number that is fixed by
writing the rows out first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import normalize_text, word_tokens
from ..session import checkpoint_root, scratch_path
from .ordering import dense_index

# Vocabulary filter (absolute minimum, proportional maximum).
MIN_DF = 2
MAX_DF = 0.95
# Vocabulary broadcast bound, in measured bytes of terms plus fixed bytes per entry.
VOCAB_BROADCAST_MAX_BYTES = 32 * 1024 * 1024
VOCAB_ENTRY_BYTES = 32

# Bytes of words that Python counts at a time, and that make a chunk of written rows.
SLICE_BYTES = 2 * 1024 * 1024
CHUNK_BYTES = 4 * 1024 * 1024

# Buckets of terms to a shuffle partition when documents are counted.
BUCKETS = 8
# Buckets over which the pairs of one first word are dealt.
SPREAD = 16

WORDS = "_words"


def sublinear_tf(tf) -> F.Column:
    """1 + ln(tf) (T5)."""
    return F.lit(1.0) + F.log(F.col(tf) if isinstance(tf, str) else tf)


def smooth_idf(df_col, n_docs: int) -> F.Column:
    """ln((1 + N) / (1 + df)) + 1 (T6).  Not Spark ML's IDF, which lacks the +1."""
    d = F.col(df_col) if isinstance(df_col, str) else df_col
    return F.log(F.lit(float(1 + n_docs)) / (F.lit(1.0) + d.cast("double"))) + F.lit(1.0)


def worded(docs: DataFrame, text: str = "text", carry=()) -> DataFrame:
    """(*carry, words joined by spaces): T1 and T2 of each row; a null text has no words. What it returned before is taken as it is."""
    if WORDS in docs.columns:
        return docs.select(*carry, WORDS)
    words = F.array_join(word_tokens(normalize_text(F.col(text))), " ")
    return docs.select(*carry, F.coalesce(words, F.lit("")).alias(WORDS))


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of words (its last column) each."""
    size = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _counted(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, code, count) of the words and pairs of neighbouring words (T3) in (row, code) order, and the terms of the codes."""
    offsets, flat = _lists(pc.split_pattern(words, " "))
    row = np.repeat(np.arange(len(words)), np.diff(offsets))
    there = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # a row without words is one empty string
    coded = flat.dictionary_encode()
    known, word, row = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)[there].astype(np.int64), row[there]
    inside = np.flatnonzero(row[1:] == row[:-1])
    pair, at = np.unique(word[inside] * max(len(known), 1) + word[inside + 1], return_inverse=True)
    first, second = (known.take(pa.array(x)) for x in np.divmod(pair, max(len(known), 1)))
    terms = pa.concat_arrays([known, pc.binary_join_element_wise(first, second, " ")])
    n = len(terms) or 1
    key, tf = np.unique(np.concatenate([row, row[inside]]) * n + np.concatenate([word, at + len(known)]), return_counts=True)
    row, code = np.divmod(key, n)
    return row, code, tf, terms


def _lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and the flat values of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.values.slice(offsets[0], offsets[-1] - offsets[0])


def _parts(terms: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of terms, and the numbers of each term's first and second word (-1: none)."""
    offsets, flat = _lists(pc.split_pattern(terms, " ", max_splits=1))
    coded = flat.dictionary_encode()
    word = np.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), -1)
    return coded.dictionary, word[offsets[:-1]], np.where(np.diff(offsets) == 2, word[offsets[:-1] + 1], -1)


def _ranks(parts: tuple[pa.Array, np.ndarray, np.ndarray]) -> np.ndarray:
    """The place of each of some distinct terms, given in parts, in their order (a space comes before all characters of words)."""
    words, first, second = parts
    rank = np.empty(len(words) + 1, np.int64)
    rank[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
    rank[-1] = -1
    out = np.empty(len(first), np.int64)
    out[np.argsort(rank[first] * (len(words) + 1) + rank[second] + 1, kind="stable")] = np.arange(len(first))
    return out


def _buckets(parts: tuple[pa.Array, np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """A bucket of each term, given in parts: terms with the same first word share ``SPREAD`` of them."""
    words, first, second = parts
    hashes = np.zeros(len(words) + 1, np.uint64)
    if len(words):
        hashes[:-1] = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)
    pair = (hashes[first] * np.uint64(0x9E3779B97F4A7C15) ^ hashes[second]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return ((hashes[first] % np.uint64(n) + (pair >> np.uint64(33)) % np.uint64(SPREAD)) % np.uint64(n)).astype(np.int32)


def _list_array(row: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32)), values)


def _with(schema: T.StructType, drop: tuple[str, ...], ddl: str) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in drop] + T.StructType.fromDDL(ddl).fields)


def term_counts(docs: DataFrame, text: str = "text", carry=()) -> DataFrame:
    """(*carry, term, tf): one row per input row and distinct term, counted inside the row."""
    rows = worded(docs, text, carry)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, SLICE_BYTES):
                row, code, tf, terms = _counted(batch.column(batch.num_columns - 1))
                counted = [_list_array(row, batch.num_rows, terms.take(pa.array(code))), _list_array(row, batch.num_rows, pa.array(tf, pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counted], [*batch.schema.names[:-1], "_t", "_n"])

    counted = rows.mapInArrow(work, _with(rows.schema, (WORDS,), "_t array<string>, _n array<bigint>"))
    return counted.select(*carry, F.inline(F.arrays_zip(F.col("_t").alias("term"), F.col("_n").alias("tf"))))


class TermTable:
    """Numbers of terms by a sorted table of their hashes, built once on the driver and shared; a match is compared as text."""

    def __init__(self, terms: pa.Array) -> None:
        self.terms = terms
        for self.key in (f"{i:016d}" for i in range(64)):
            hashes = self._hashes(terms)
            self.order = np.argsort(hashes, kind="stable")
            self.hashes = hashes[self.order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():
                return
        raise ValueError("the vocabulary holds a term twice")

    def _hashes(self, terms: pa.Array) -> np.ndarray:
        values = terms.to_numpy(zero_copy_only=False)
        return pd.util.hash_array(values, hash_key=self.key, categorize=False) if len(values) else np.zeros(0, np.uint64)

    def find(self, terms: pa.Array) -> np.ndarray:
        """The number of each term, -1 for one that is not known; each distinct term is looked up once."""
        if len(self.terms) == 0 or len(terms) == 0:
            return np.full(len(terms), -1)
        coded = terms.dictionary_encode()
        hashes = self._hashes(coded.dictionary)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        number = np.where(self.hashes[at] == hashes, self.order[at], -1)
        hit = np.flatnonzero(number >= 0)
        same = pc.equal(self.terms.take(pa.array(number[hit])), coded.dictionary.take(pa.array(hit))).to_numpy(zero_copy_only=False)
        number[hit[~same]] = -1
        return number[coded.indices.to_numpy(zero_copy_only=False)]


@dataclass
class Vocabulary:
    """Fitted vocabulary: table (term, idx, df, idf), its size, measured bytes and the training row count."""

    table: DataFrame
    size: int
    n_docs: int
    nbytes: int | None = None
    _shared: object = field(default=None, repr=False)

    def small(self) -> bool:
        if self.nbytes is None:
            self.nbytes = self.table.agg(F.sum(F.octet_length("term"))).first()[0] or 0
        return self.nbytes + VOCAB_ENTRY_BYTES * self.size <= VOCAB_BROADCAST_MAX_BYTES

    def shared(self):
        """Terms (with their table) and idf in idx order, sent to the tasks once; only for a vocabulary of checked size."""
        if self._shared is None:
            t = self.table.select("term", "idx", "idf").toArrow().sort_by("idx")
            terms = t["term"].combine_chunks()
            terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
            self._shared = self.table.sparkSession.sparkContext.broadcast((TermTable(terms), t["idf"].to_numpy()))
        return self._shared


def document_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, df): the rows that hold each term; beside a null term the number of rows.

    Terms travel packed: a row per chunk of words, bucket and count holds its
    distinct terms in order as one string.  They are taken apart where a
    bucket's rows have met, so summing them needs no exchange of its own.
    """
    buckets = BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, CHUNK_BYTES):
                _, code, _, terms = _counted(batch.column(batch.num_columns - 1))
                df = np.bincount(code, minlength=len(terms))
                there = np.flatnonzero(df)
                df, terms = df[there], terms.take(pa.array(there))
                parts = _parts(terms)
                bucket = _buckets(parts, buckets)
                order = np.lexsort((_ranks(parts), df, bucket))
                bucket, df = bucket[order], df[order]
                start = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (df[1:] != df[:-1]))) if len(df) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(df)).astype(np.int32)), terms.take(pa.array(order)))
                packed = pa.concat_arrays([pc.binary_join(lists, "\n"), pa.nulls(1, pa.string())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(bucket[start], -1).astype(np.int32)), pa.array(np.append(df[start], batch.num_rows).astype(np.int64)), packed],
                    ["bucket", "n", "packed"],
                )

    met = worded(docs, text).mapInArrow(work, "bucket int, n long, packed string").repartition("bucket")
    terms = met.select("bucket", "n", F.explode_outer(F.split("packed", "\n")).alias("term"))
    return terms.groupBy("bucket", "term").agg(F.sum("n").alias("df")).select("term", "df")


def fit_vocabulary(docs: DataFrame, text: str = "text", min_df: int = MIN_DF, max_df: float = MAX_DF) -> Vocabulary:
    """Terms with min_df <= df <= max_df * N, indexed in term order, with smoothed IDF.

    N counts rows.  One pass gives both; only counted terms are written out.
    """
    counts = document_counts(docs, text)
    checkpoint_root(docs.sparkSession)
    counts = counts.filter((F.col("df") >= min_df) | F.col("term").isNull()).checkpoint()
    first = counts.filter("term is null").first()
    n_docs = first["df"] if first else 0
    kept = counts.filter(F.col("term").isNotNull() & (F.col("df") >= min_df))
    kept = kept.filter(F.col("df").cast("double") <= F.lit(float(max_df)) * F.lit(float(n_docs)))
    table = dense_index(kept, ["term"], "idx").withColumn("idf", smooth_idf("df", n_docs)).select("term", "idx", "df", "idf")
    size, nbytes = table.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
    return Vocabulary(table, size, n_docs, nbytes or 0)


def transform(docs: DataFrame, vocab: Vocabulary, text: str = "text", carry=(), keep_terms: bool = False) -> DataFrame:
    """One sparse L2-normalised row per input row.

    Output: *carry, ``idx`` array<bigint>, ``val`` array<double> (sorted by
    idx; empty for a row with no known term), and ``terms`` when asked.
    Unknown terms are dropped.
    """
    rows = worded(docs, text, carry)
    names = ["idx", "val"] + ["terms"] * keep_terms
    schema = _with(rows.schema, (WORDS,), "idx array<bigint>, val array<double>" + ", terms array<string>" * keep_terms)

    def sparse(n: int, row, idx, w, terms) -> list[pa.Array]:
        out = [_list_array(row, n, pa.array(idx.astype(np.int64))), _list_array(row, n, pa.array(_unit(row, w, n)))]
        return out + ([_list_array(row, n, terms())] if keep_terms else [])

    if not vocab.small():
        def packed(n, row, code, w, known, terms):
            order = np.lexsort((known["idx"][code], row))
            row, code, w = row[order], code[order], w[order]
            return sparse(n, row, known["idx"][code], w, lambda: terms.take(pa.array(code)))

        return _looked_up(rows, vocab.table.select("term", "idx", "idf"), packed, schema, names, keep_terms)
    shared = vocab.shared()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        for whole in batches:
            for batch in _slices(whole, SLICE_BYTES):
                row, code, tf, terms = _counted(batch.column(batch.num_columns - 1))
                idx = known.find(terms)[code]
                row, idx, tf = row[idx >= 0], idx[idx >= 0], tf[idx >= 0]
                order = np.lexsort((idx, row))
                row, idx, tf = row[order], idx[order], tf[order]
                out = sparse(batch.num_rows, row, idx, (1.0 + np.log(tf)) * idf[idx], lambda: known.terms.take(pa.array(idx)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *out], [*batch.schema.names[:-1], *names])

    return rows.mapInArrow(work, schema)


def decisions(docs: DataFrame, vocab: Vocabulary, coefs: DataFrame, biases: list[float], text: str = "text", carry=(), out: str = "scores") -> DataFrame:
    """(*carry, scores array): w.x + b of several models for each row, where vocabulary or coefficients are not broadcast.

    ``coefs`` is an (idx, coefs array) table with one coefficient per model; an idx without a row counts as 0.
    """
    rows, width = worded(docs, text, carry), len(biases)
    schema = _with(rows.schema, (WORDS,), f"{out} array<double>")
    none = F.array_repeat(F.lit(0.0), width)
    table = vocab.table.select("term", "idx", "idf").join(coefs.select("idx", "coefs"), "idx", "left").select("term", "idf", F.coalesce("coefs", none).alias("coefs"))

    def scored(n, row, code, w, known, terms):
        w, coef = _unit(row, w, n), known["coefs"].reshape(-1, width)
        s = np.stack([np.bincount(row, w * coef[code, k], minlength=n) for k in range(width)], 1) + np.array(biases)
        return [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(s.ravel()))]

    # the coefficients of a chunk's terms take no more room than its words
    return _looked_up(rows, table, scored, schema, [out], False, max(SLICE_BYTES // 16, CHUNK_BYTES // width))


def _unit(row: np.ndarray, w: np.ndarray, n: int) -> np.ndarray:
    norm = np.sqrt(np.bincount(row, w * w, minlength=n))
    return w / np.where(norm > 0, norm, 1.0)[row]


def _looked_up(rows: DataFrame, table: DataFrame, make, schema: T.StructType, names: list[str], keep_terms: bool, chunk_bytes: int | None = None) -> DataFrame:
    """``make`` of the entries of rows whose terms are in ``table`` (term, idf, ...), a table of any size.

    Rows are written once as packed chunks; a chunk asks for each of its
    distinct terms once, in a string per bucket, and gets the table's columns back.  ``make(n, row, code,
    weight, columns by code, terms by code)`` gives the columns ``names`` of the
    chunk's n rows.
    """
    spark, limit = rows.sparkSession, chunk_bytes or CHUNK_BYTES
    wanted = [f for f in table.columns if f != "term"]
    buckets = BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "chunks")
    kinds = "chunk bigint, n int, carried binary, size binary, code binary, tf binary, terms array<string>, bucket int, start int, ask string"
    layout = pa.schema([("chunk", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("carried", "size", "code", "tf")),
                        ("terms", pa.list_(pa.string())), ("bucket", pa.int32()), ("start", pa.int32()), ("ask", pa.string())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for whole in batches:
            for batch in _slices(whole, limit):
                row, code, tf, terms = _counted(batch.column(batch.num_columns - 1))
                # terms by bucket and in order, entries by term: neighbours are alike, which packs well
                parts = _parts(terms)
                bucket = _buckets(parts, buckets)
                order = np.lexsort((_ranks(parts), bucket))
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                code, terms, bucket = place[code], terms.take(pa.array(order)), bucket[order]
                order = np.lexsort((code, row))
                code, tf = code[order], tf[order]
                carried = pa.RecordBatch.from_arrays(batch.columns[:-1], batch.schema.names[:-1])
                cells = {"chunk": pa.array([chunk]), "n": pa.array([batch.num_rows], pa.int32()), "carried": pa.array([_to_bytes(carried)], pa.binary())}
                cells |= {"size": pa.array([_packed(np.bincount(row, minlength=batch.num_rows))], pa.binary())}
                cells |= {k: pa.array([_packed(v)], pa.binary()) for k, v in (("code", code), ("tf", tf))}
                kept = terms if keep_terms else terms.slice(0, 0)
                cells["terms"] = pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept)
                start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
                edge = pa.array(np.append(start, len(bucket)).astype(np.int32))
                asks = {"chunk": pa.array(np.full(len(start), chunk)), "terms": pa.ListArray.from_arrays(pa.array(np.zeros(len(start) + 1, np.int32)), terms.slice(0, 0))}
                asks |= {"bucket": pa.array(bucket[start]), "start": pa.array(start.astype(np.int32)), "ask": pc.binary_join(pa.ListArray.from_arrays(edge, terms), "\n")}
                for part in (cells, asks):
                    n = len(part["chunk"])
                    yield pa.RecordBatch.from_arrays([part[f.name] if f.name in part else pa.nulls(n, f.type) for f in layout], schema=layout)
                chunk += 1

    rows.mapInArrow(pack, kinds).write.option("compression", "zstd").parquet(path)
    # read apart, so that the two sides have columns of their own
    chunks, asked = (spark.read.schema(kinds).parquet(path).filter(which) for which in ("bucket is null", "bucket is not null"))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = pa.array(_buckets(_parts(batch.column(batch.schema.get_field_index("term"))), buckets))
            yield pa.RecordBatch.from_arrays([*batch.columns, bucket], [*batch.schema.names, "bucket"])

    known = table.mapInArrow(dealt, _with(table.schema, (), "bucket int"))
    known = known.select("bucket", F.lit(None).cast("bigint").alias("chunk"), F.lit(0).alias("start"), F.col("term").alias("ask"), F.struct(*wanted).alias("value"))
    asked = asked.select("bucket", "chunk", "start", "ask", F.lit(None).cast(known.schema["value"].dataType).alias("value"))
    # what is asked stays packed until it has met the table's terms of its bucket
    met = known.unionByName(asked).repartition("bucket")
    met = met.select("bucket", "chunk", "start", "value", F.posexplode(F.split("ask", "\n")).alias("at", "term"))
    value = F.first("value", ignorenulls=True).over(Window.partitionBy("bucket", "term"))
    found = met.select("chunk", (F.col("start") + F.col("at")).alias("at"), value.alias("value"))
    found = found.filter("chunk is not null and value is not null").select("chunk", "at", "value.*")

    def work(key, chunk: pa.Table, found: pa.Table) -> pa.Table:
        one = chunk.slice(0, 1).to_pylist()[0] if not keep_terms else chunk.drop(["terms"]).to_pylist()[0]
        n = one["n"]
        row = np.repeat(np.arange(n), _unpacked(one["size"]))
        code, tf = (_unpacked(one[k]) for k in ("code", "tf"))
        at = found["at"].to_numpy()
        place = np.full(max(int(code.max(initial=-1)), int(at.max(initial=-1))) + 1, -1)
        place[at] = np.arange(len(at))
        known = {}
        for name in wanted:
            column = found[name].combine_chunks()
            column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
            known[name] = (column.flatten() if pa.types.is_list(column.type) else column).to_numpy(zero_copy_only=False)
        here = place[code] >= 0
        row, tf, code = row[here], tf[here], place[code][here]
        terms = chunk["terms"].chunk(0).flatten().take(pa.array(at)) if keep_terms else None
        made = make(n, row, code, (1.0 + np.log(tf)) * known["idf"][code], known, terms)
        carried = _from_bytes(one["carried"])
        return pa.table([*carried.columns, *made], names=[*carried.schema.names, *names])

    left = chunks.drop("bucket", "start", "ask", *([] if keep_terms else ["terms"]))
    return left.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(work, schema)


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers of 32 bits as compressed differences, all first bytes before all second ones and so on."""
    apart = np.diff(numbers.astype(np.int32), prepend=np.int32(0)).astype(np.int32)
    cells = np.ascontiguousarray(apart.view(np.uint8).reshape(-1, 4).T)
    return len(apart).to_bytes(8, "little") + pa.compress(cells.tobytes(), "zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    cells = np.frombuffer(pa.decompress(data[8:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(cells.T).view(np.int32).ravel(), dtype=np.int64).astype(np.int32)


def _to_bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data).read_next_batch()


def to_long(packed: DataFrame, carry=("doc_id",)) -> DataFrame:
    """Sparse rows -> (*carry, term, idx, weight); needs ``keep_terms=True`` rows."""
    z = F.arrays_zip(F.col("idx").alias("idx"), F.col("val").alias("weight"), F.col("terms").alias("term"))
    return packed.select(*carry, F.inline(z)).select(*carry, "term", "idx", "weight")
