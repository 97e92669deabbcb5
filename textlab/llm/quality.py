"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, linear hinge loss by dual coordinate descent.

Indicators are hashed byte 2- and 3-grams and 1- and 2-grams of word forms
(initial and second byte's kind, final sign, length, whether the word repeats
the one before).  The ratios and the hinge-loss fit use a sample of labelled
rows of bounded size; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks
from .words import U, mix, split, word_hashes

#: log2 of the number of hashed indicators.
BITS = 18
#: Labelled rows that the fit uses at most: those with the smallest hashes of their ids.
FIT_ROWS = 8_000
#: Cost of a unit of hinge loss, and passes over the fitted rows.
COST = 1.0
EPOCHS = 8

_KIND = np.zeros(256, np.uint64)  # 0 other signs
_KIND[[*range(97, 123)]] = 1
_KIND[[*range(65, 91)]] = 2
_KIND[[*range(48, 58)]] = 3
_KIND[128:] = 4


def indicators(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, indicator) places of a chunk, repeats included."""
    n, shift = len(off) - 1, U(64 - BITS)
    docs, marks = [], []
    owner = np.repeat(np.arange(n), np.diff(off))
    wide = buf.astype(np.uint64)
    for k in (2, 3):
        if len(buf) >= k:
            code = np.zeros(len(buf) - k + 1, np.uint64)
            for j in range(k):
                code = (code << U(8)) | wide[j : len(buf) - k + 1 + j]
            same = owner[: len(code)] == owner[k - 1 :]
            docs.append(owner[: len(code)][same])
            marks.append((mix(code[same], k) >> shift).astype(np.int32))
    start, end, doc = split(buf, off)
    if len(start):
        h = word_hashes(buf, start, end)
        again = np.zeros(len(h), np.uint64)
        again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
        second = np.minimum(start + 1, end - 1)
        form = _KIND[buf[start]] | _KIND[buf[second]] << U(3) | again << U(6) | np.minimum(end - start, 7).astype(np.uint64) << U(7)
        last = wide[end - 1]
        form |= np.where(_KIND[buf[end - 1]] == 0, last, U(0)) << U(10)
        docs.append(doc)
        marks.append((mix(form, 11) >> shift).astype(np.int32))
        two = doc[1:] == doc[:-1]
        docs.append(doc[1:][two])
        marks.append((mix(form[1:][two] << U(20) | form[:-1][two], 13) >> shift).astype(np.int32))
    return docs, marks


def per_document(buf: np.ndarray, off: np.ndarray, seen: np.ndarray) -> Iterator[np.ndarray]:
    """Each document's distinct indicators; `seen` is an all-false table that is left so."""
    n = len(off) - 1
    docs, marks = indicators(buf, off)
    edges = [np.searchsorted(d, np.arange(n + 1)) for d in docs]
    for i in range(n):
        for m, e in zip(marks, edges, strict=True):
            seen[m[e[i] : e[i + 1]]] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


def fit(rows: list[np.ndarray], y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights of the indicators and the bias; without rows of both kinds, no weights and the sign of the only kind."""
    size = 1 << BITS
    if len(y) == 0 or y.min() == y.max():
        return np.zeros(size, np.float32), 0.0 if len(y) == 0 else (1.0 if y[0] else -1.0)
    good, bad = np.ones(size), np.ones(size)
    for x, label in zip(rows, y, strict=True):
        (good if label else bad)[x] += 1
    ratio = np.log(good / good.sum()) - np.log(bad / bad.sum())
    scaled = [(ratio[x] / max(np.linalg.norm(ratio[x]), 1e-12)).astype(np.float32) for x in rows]
    sign = np.where(y, 1.0, -1.0)
    w, bias, alpha, dice = np.zeros(size), 0.0, np.zeros(len(y)), np.random.default_rng(3)
    for _ in range(epochs):
        for i in dice.permutation(len(y)):
            x, v = rows[i], scaled[i]
            slack = sign[i] * (w[x] @ v + bias) - 1
            new = min(max(alpha[i] - slack / 2.0, 0.0), cost)  # rows have length 1, the bias input too
            step = (new - alpha[i]) * sign[i]
            if step:
                w[x] += step * v
                bias += step
                alpha[i] = new
    # the weights of a row's indicators times its scaled ratios: w * ratio, over the norm of its ratios
    return np.stack([w * ratio, np.square(ratio)]).astype(np.float32), float(bias)


def margin(model: np.ndarray, bias: float, found: np.ndarray) -> float:
    if model.ndim == 1:
        return bias
    return float(model[0, found].sum(dtype=np.float64)) / max(float(model[1, found].sum(dtype=np.float64)) ** 0.5, 1e-12) + bias


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + float(np.exp(-x))) if x >= 0 else float(np.exp(x)) / (1.0 + float(np.exp(x)))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[np.ndarray, float]:
    """The model, fitted on at most `fit_rows` rows of `docs` (doc_id, text) with a label in `labels` (doc_id, good).

    Labels of documents that `docs` does not have, and repeated rows, take no place among them.
    """
    present = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = labels.join(present, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)  # bounded, so it may be broadcast
    rows = docs.join(F.broadcast(chosen), "doc_id").select("good", F.xxhash64("doc_id", "text").alias("place"), "text")

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            for a, b, buf, off in chunks(batch.column(2)):
                found = [x.astype(np.int32) for x in per_document(buf, off, seen)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array([x.tobytes() for x in found], pa.binary())],
                    ["good", "place", "marks"],
                )

    def solve(table):
        table = table.sort_by([("place", "ascending"), ("good", "ascending")])
        found = [np.frombuffer(x.as_buffer(), np.int32) for x in table["marks"]]
        model, bias = fit(found, table["good"].to_numpy().astype(bool))
        return pa.table({"model": [model.tobytes()], "scaled": [model.ndim == 2], "bias": [bias]})

    found = rows.mapInArrow(marks, "good boolean, place long, marks binary").dropDuplicates(["good", "place"]).orderBy("place").limit(fit_rows)
    got = found.groupBy(F.lit(0).alias("all")).applyInArrow(solve, "model binary, scaled boolean, bias double").collect()
    if not got:
        return np.zeros(1 << BITS, np.float32), 0.0
    model = np.frombuffer(got[0]["model"], np.float32)
    return (model.reshape(2, -1) if got[0]["scaled"] else model), got[0]["bias"]


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    fit_rows: int = FIT_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(doc_id, held_out, score, predicted, *keep) for every row of `docs`.

    `held_out` is a condition on ``doc_id`` (default: crc32 of its text, modulo
    3, is 1); labels of such ids are not learned from.  `keep` names columns of
    `docs` that are handed on.  Only the text enters a score.  A null text is
    empty and is scored as such; a null doc_id is not held out and has no
    label; repeated rows each give a row; null labels are left out and an id
    with several labels takes their majority, ties being good; with labels of
    one kind only, every text is predicted to be of that kind, and with no
    labels at all every score is 0.5.  An empty table gives no rows.
    """
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1 if held_out is None else held_out, F.lit(False))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.struct(F.lit(0).alias("_"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep))).alias("rest"),
    )
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & ~out)
    known = known.groupBy("doc_id").agg((F.avg((F.col("y") >= 1).cast("double")) >= 0.5).alias("good"))
    model, bias = train(rows.select("doc_id", "text"), known, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast((model, bias))  # 2 * 2**BITS floats at any size of the data

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bias = shared.value
        seen = np.zeros(1 << BITS, bool)
        for batch in batches:
            for a, b, buf, off in chunks(batch.column(1)):
                p = np.array([sigmoid(margin(model, bias, x)) for x in per_document(buf, off, seen)])
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), part.column(2)],
                    ["doc_id", "score", "predicted", "rest"],
                )

    kept = rows.schema["rest"].dataType.simpleString()
    scored = rows.mapInArrow(score, f"doc_id long, score double, predicted int, rest {kept}")
    return scored.select(
        "doc_id", out.alias("held_out"), "score", "predicted", *(F.col(f"rest.c{i}").alias(c) for i, c in enumerate(keep))
    )
