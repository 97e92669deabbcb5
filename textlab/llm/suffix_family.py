"""Suffix-array dedup with a logarithmic family of indexes.

The suffixes at sampled places of all documents are dealt by the hash of their
first bytes; a place is sampled where the hash of its first GRAM bytes is the
least in some window, so equal windows have their sampled suffix at the same
place.  Within a part, batches of suffixes come in document order.  A new batch
is sorted into a suffix array, scanned against the arrays of all levels for
suffixes that agree, and becomes the lowest level; levels of equal size are
merged, so there are logarithmically many.  Merging keeps, of suffixes that agree
in all of their segment, the first, so that a passage repeated without end holds
one entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .repeats import PLACE, merged, pack_segments, resolved
from .words import U, byte_prefix, mix, ranges

WIDTH = 100
#: Bytes that name a sampled suffix: longer ones make more samples, but fewer that agree by chance.
GRAM = 40
#: Suffixes to a new batch.
BATCH = 1 << 16


def segments_of(width: int, gram: int):
    places = width - gram + 1

    def segments(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
        size = np.diff(off)
        many = np.maximum(size - width + 1, 0)
        total = int(many.sum())
        if total == 0:
            none = np.zeros(0, np.int64)
            return none, none, none, none.view(np.uint64), none.view(np.uint64)
        sums = byte_prefix(buf)
        at = np.arange(len(buf) - gram + 1)
        names = ranges(sums, at, at + gram)
        bits = U(max(26, int(len(buf)).bit_length()))
        value = (names >> bits) << bits | at.astype(np.uint64)  # the first of equal names is the least
        step = 1
        while 2 * step <= places:
            value = np.minimum(value[:-step], value[step:])
            step *= 2
        if places > step:
            value = np.minimum(value[: len(value) - (places - step)], value[places - step :])
        doc = np.repeat(np.arange(len(size)), many)
        first = np.arange(total) - np.repeat(np.cumsum(many) - many, many) + off[doc]
        anchor = (value[first] & ((U(1) << bits) - U(1))).astype(np.int64)
        place, n = pack_segments(anchor, first)
        a = first[place]
        ctx = mix(ranges(sums, a, a + n - 1 + width) + (anchor[place] - a).astype(np.uint64), 31)
        return doc[place], a - off[doc[place]], n, names[anchor[place]], ctx

    return segments


def pair_name(key: np.ndarray, ctx: np.ndarray) -> np.ndarray:
    return mix(mix(key.view(np.uint64), 41) + ctx.view(np.uint64), 43)


class Level:
    """A suffix array: entries in (key, ctx) order, and the order of their joint names.

    Entries of a key are all told if there are several, as they differ in ctx;
    so an entry not told is its key's only one here.
    """

    def __init__(self, key, ctx, place, told) -> None:
        self.key, self.ctx, self.place, self.told = key, ctx, place, told
        names = pair_name(key, ctx)
        self.by_name = np.argsort(names)
        self.names = names[self.by_name]

    def __len__(self) -> int:
        return len(self.key)

    def agreeing(self, key, ctx, names) -> np.ndarray:
        """The entry that agrees with each probe in key and ctx, or -1."""
        if len(self) == 0:
            return np.full(len(key), -1)
        entry = self.by_name[np.minimum(np.searchsorted(self.names, names), len(self) - 1)]
        return np.where((self.key[entry] == key) & (self.ctx[entry] == ctx), entry, -1)


class Family:
    """The levels of one part's index."""

    def __init__(self) -> None:
        self.levels: list[Level] = []

    def add(self, key: np.ndarray, ctx: np.ndarray, place: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Takes a batch in document order; gives (key, place, ctx, kind) of entries to cover (0) or to take apart (1).

        A place is a row of numbers that name the document and the position in it.
        """
        order = np.lexsort((np.arange(len(key)), ctx, key))
        key, ctx, place = key[order], ctx[order], place[order]
        names, out = pair_name(key, ctx), []
        again = np.zeros(len(key), bool)
        again[1:] = (key[1:] == key[:-1]) & (ctx[1:] == ctx[:-1])
        lead = np.maximum.accumulate(np.where(~again, np.arange(len(key)), 0))
        cover = again & (place != place[lead]).any(axis=1)
        conflict = np.zeros(len(key), bool)
        differ = (key[1:] == key[:-1]) & (ctx[1:] != ctx[:-1])
        if differ.any():
            conflict = np.isin(key, np.unique(key[1:][differ]))
        for level in self.levels:
            entry = level.agreeing(key, ctx, names)
            found = entry >= 0
            again |= found
            if found.any():
                cover[found] |= (level.place[entry[found]] != place[found]).any(axis=1)
            lo, hi = np.searchsorted(level.key, key, "left"), np.searchsorted(level.key, key, "right")
            other = (hi - lo) > found
            conflict |= other
            fresh = np.unique(lo[other])
            fresh = fresh[~level.told[fresh]]
            if len(fresh):
                level.told[fresh] = True
                out.append((level.key[fresh], level.place[fresh], level.ctx[fresh], np.ones(len(fresh), np.int32)))
        if cover.any():
            out.append((key[cover], place[cover], ctx[cover], np.zeros(int(cover.sum()), np.int32)))
        new = ~again
        # a key with one entry in an older level and one here is told in both, whichever came with the conflict
        told = conflict & new
        if told.any():
            out.append((key[told], place[told], ctx[told], np.ones(int(told.sum()), np.int32)))
        self.levels.append(Level(key[new], ctx[new], place[new], told[new]))
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) >= len(self.levels[-2]):
            late, early = self.levels.pop(), self.levels.pop()
            both = [np.concatenate([getattr(early, c), getattr(late, c)]) for c in ("key", "ctx", "place", "told")]
            by = np.lexsort((both[1], both[0]))
            self.levels.append(Level(*(c[by] for c in both)))
        return out


def by_family(rows: DataFrame, batch_rows: int = BATCH) -> DataFrame:
    """(key, d, tag, tag2, at, ctx, known, kind) of the segments that matter."""
    names = ["key", *PLACE, "ctx", "known", "kind"]

    def batch_of(key, place, ctx, known, kind) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (key, *place, ctx, known, kind)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, held, n = Family(), [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, *place, ctx = (np.concatenate([h[i] for h in held]) for i in range(6))
            for key, place, ctx, kind in family.add(key, ctx, np.stack(place, axis=1)):
                yield batch_of(key, place.T.copy(), ctx, np.zeros(len(key), bool), kind)

        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            known = cols[6]
            if known.any():
                key, *place, ctx = (c[known] for c in cols[:6])
                yield batch_of(key, place, ctx, known[known], np.zeros(int(known.sum()), np.int32))
            held.append([c[~known] for c in cols[:6]])
            n += len(held[-1][0])
            if n >= batch_rows:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    dealt = rows.repartition("key").sortWithinPartitions(*PLACE)
    return dealt.mapInArrow(work, "key long, d long, tag long, tag2 long, at long, ctx long, known boolean, kind int")


def window_hashes(width: int):
    def windows(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        return ranges(byte_prefix(buf), at, at + width)

    return windows


def suffix_dedup(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each document's UTF-8 bytes without those of repeated strings.

    A byte goes if it lies in a string of `width` bytes that also starts
    earlier: in a document of a smaller doc_id, or earlier in the same one;
    strings may overlap and are judged on the input.  `kept` holds the bytes
    that stay, n_spans counts the maximal removed runs.  A null text is empty; a
    null doc_id counts as smaller than all others; different texts under one
    doc_id are ordered by a hash of the text; a row listed twice is one document
    and gets its result twice; an empty table gives no rows; other columns are
    ignored.
    """
    if not 8 <= gram <= width:
        raise ValueError("gram must be from 8 to width")
    found = resolved(docs, segments_of(width, gram), by_family, window_hashes(width), width, id_col, text_col)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, many, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode()
                starts, ends = merged(spans)
                out, at = [], 0
                for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
                    out.append(raw[at:a])
                    at = b
                out.append(raw[at:])
                n.append(len(raw))
                many.append(len(starts))
                kept.append(b"".join(out))
                gone.append(len(raw) - len(kept[-1]))
            longs = (pa.array(c, pa.int64()) for c in (n, gone, many))
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return found.mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
