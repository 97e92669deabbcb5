"""Substring dedup by recompression.

Rounds name runs of one symbol and pairs of neighbouring symbols.  Names are
hashes of what they stand for, so every task of the cluster gives equal runs and
pairs equal names, and a round needs no exchange.  A pair is named where a
symbol of the round's left class stands before one of its right class.  Each
symbol carries the stretch of words that its making depended on; inside an
equal stretch of words the same symbols come about.  A window hangs on the
symbol of the highest level whose stretch it holds (the one with the least name,
the first of those); the join of all stretches with equal content is Spark's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import by_windows, merged, pack_segments, resolved
from .words import U, mix, prefix, ranges, split, word_hashes

WIDTH = 20
ROUNDS = 2


def sides(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a symbol is its document's first, and last."""
    first, last = np.ones(len(doc), bool), np.ones(len(doc), bool)
    first[1:] = doc[1:] != doc[:-1]
    last[:-1] = first[1:]
    return first, last


def shifted(values: np.ndarray, at: np.ndarray, by: int) -> np.ndarray:
    return values[np.clip(at + by, 0, max(0, len(values) - 1))]


def runs(name, low, high, doc, edge):
    """Runs of one symbol become one; a run of one keeps its name. What stands on either side is depended on as well.

    `edge` has the stretch that no window of a document holds: from before its first word to behind its last.
    """
    first, last = sides(doc)
    new = first.copy()
    new[1:] |= name[1:] != name[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(name)))
    end = at + size - 1
    before = np.where(first[at], edge[0][doc[at]], shifted(low, at, -1))
    after = np.where(last[end], edge[1][doc[at]], shifted(high, end, 1))
    return np.where(size > 1, mix(name[at] + U(0x51ED270B) * size.astype(np.uint64), 3), name[at]), before, after, doc[at]


def pairs(name, low, high, doc, edge, level):
    """Pairs of a left symbol before a right one become one."""
    first, last = sides(doc)
    right = (mix(name, 100 + level) >> U(63)).astype(bool)
    at = np.arange(len(name))
    joined = ~right & shifted(right, at, 1) & ~last
    second = right & shifted(joined, at, -1) & ~first
    # alone: a left one because of what follows, a right one because of what stands before
    after = np.where(last, edge[1][doc], shifted(high, at, 1))
    before = np.where(first, edge[0][doc], shifted(low, at, -1))
    name = np.where(joined, mix(mix(name, 5) + shifted(name, at, 1), 7), name)
    keep = ~second
    return name[keep], np.where(right, before, low)[keep], np.where(right, high, after)[keep], doc[keep]


def least(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Place of the first least value in each non-empty range [lo, hi)."""
    best = [np.arange(len(values))]
    size = 1
    while 2 * size <= int((hi - lo).max(initial=1)):
        a, b = best[-1][:-size], best[-1][size:]
        best.append(np.where(values[a] <= values[b], a, b))
        size *= 2
    level = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), np.int64)
    for k, table in enumerate(best):
        at = np.flatnonzero(level == k)
        a, b = table[lo[at]], table[hi[at] - (1 << k)]
        out[at] = np.where(values[a] <= values[b], a, b)
    return out


def segments_of(width: int, rounds: int):
    def segments(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        start, end, doc = split(buf, off)
        words = word_hashes(buf, start, end)
        n_docs = len(off) - 1
        count = np.bincount(doc, minlength=n_docs)
        begin = np.cumsum(count) - count
        first = np.arange(max(0, len(words) - width + 1))
        first = first[doc[first] == doc[first + width - 1]]
        if len(first) == 0:
            none = np.zeros(0, np.int64)
            return none, none, none, none.view(np.uint64), none.view(np.uint64)
        sums = prefix(words)
        # each window's anchor: its stretch of words, from the highest level that has one
        low_at, high_at = np.empty(len(first), np.int64), np.full(len(first), -1, np.int64)
        at = np.arange(len(words))
        levels = [(words, at, at + 1, doc)]
        edge = begin - 1, begin + count + 1
        for r in range(1, rounds + 1):
            levels.append(pairs(*runs(*levels[-1], edge), edge, r))
        for name, low, high, _ in reversed(levels):
            open_ = np.flatnonzero(high_at < 0)
            lo = np.searchsorted(low, first[open_], "left")
            hi = np.searchsorted(high, first[open_] + width, "right")
            some = hi > lo
            if not some.any():
                continue
            picked = least(mix(name, 9), lo[some], hi[some])
            low_at[open_[some]], high_at[open_[some]] = low[picked], high[picked]
        place, size = pack_segments(low_at * (width + 1) + (high_at - low_at), first)
        a, b = first[place], first[place] + size - 1 + width
        low, high = low_at[place], high_at[place]
        key = ranges(sums, low, high)
        ctx = mix(ranges(sums, a, b) + (low - a).astype(np.uint64), 21)
        return doc[a], a - begin[doc[a]], size, key, ctx

    return segments


def window_hashes(width: int):
    def windows(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        start, end, _ = split(buf, np.array([0, len(buf)]))
        return ranges(prefix(word_hashes(buf, start, end)), at, at + width)

    return windows


def substring_dedup(
    docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words of repeated windows.

    Words are runs of `[^\\x20\\x09-\\x0D]`.  A word goes if it lies in a window
    of `width` words whose words also stand, as a window, earlier: in a document
    of a smaller doc_id, or earlier in the same one.  Windows are judged on the
    input.  `kept` is what stays, joined by one space.  A null or empty text has
    no words; a null doc_id counts as smaller than all others; different texts
    under one doc_id are ordered by a hash of the text; a row listed twice is
    one document and gets its result twice; an empty table gives no rows; other
    columns are ignored.
    """
    found = resolved(docs, segments_of(width, rounds), by_windows, window_hashes(width), width, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = text.as_py().encode().split()
                starts, ends = merged(spans)
                out, at = [], 0
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    out += words[at:a]
                    at = b
                out += words[at:]
                n.append(len(words))
                gone.append(len(words) - len(out))
                kept.append(b" ".join(out).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return found.mapInArrow(work, "doc_id long, n_words long, n_removed long, kept string")
