"""Benchmark decontamination on a distributed positional inverted index.

The index is a stored table: segments of a few MB of text, and for each word of
a segment the sorted places where it stands.  Documents of a segment are
numbered through with gaps between them, so lists shifted by the words' offsets
never meet across documents; a longer document is dealt over several segments
that overlap by a few words.  A test item asks for the lists of its own words
only.  Per segment, every phrase starts from the list of its rarest word there,
moved back by the word's offset, and is intersected with the others' lists from
rare to frequent.  What is left are the places of the exact phrase.  For
proximity matches the same lists are narrowed by distance instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, cut, stash
from .license_scan import GAP, LOWER
from .words import split

#: Words that separate documents of a segment, and by which segments of one document overlap; no match spans more.
REACH = 64
#: Bytes of text to a segment.
SEGMENT_BYTES = 4 << 20
#: Phrases to a part of a long test item, and bytes of test items that the tasks hold at a time.
PART_PHRASES = 1000
SLICE_BYTES = 4 << 20
#: Places that one numpy step follows at a time.
STEP = 1 << 21

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Index:
    """rows: (row, doc_id, n_words), a row per document.  postings: (segment, base, offset, least, term, positions).

    The word at place p of a segment belongs to the last document that starts at
    or before p; the starts are the places of the empty term.  Document i of a
    segment is row base + i, its first word there is its word number `offset`,
    and matches that end at or before word `least` belong to the segment before.
    """

    rows: DataFrame
    postings: DataFrame
    reach: int


def _pieces(raw: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Consecutive parts of a text of about `size` bytes, cut after bytes that are in no word."""
    a = 0
    while len(raw) - a > size:
        b, look = a + size, 1 << 12
        while b < len(raw):
            gap = np.flatnonzero(GAP[raw[b : b + look]])
            if len(gap):
                b += int(gap[0]) + 1
                break
            b += look
        yield raw[a : min(b, len(raw))]
        a = min(b, len(raw))
    if a < len(raw) or len(raw) == 0:
        yield raw[a:]


def _segment(buf: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray, n_docs: int, reach: int):
    """(terms, list of places per term) of the words of a segment."""
    size = end - start
    off = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    letters = buf[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
    words = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(off), pa.py_buffer(letters.tobytes())])
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    count = np.bincount(doc, minlength=n_docs)
    first = np.cumsum(count + reach) - (count + reach)
    place = (np.arange(len(start)) + reach * doc).astype(np.int32)
    order = np.argsort(code, kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(coded.dictionary)))])
    edge = np.concatenate([[0], edge + n_docs]).astype(np.int32)
    places = pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate([first.astype(np.int32), place[order]])))
    return pa.concat_arrays([pa.array([""]), coded.dictionary]), places, count


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH, segment_bytes: int = SEGMENT_BYTES
) -> Index:
    """The positional index of every word of `docs`, written to the shared checkpoint folder.

    A null text is empty; every input row, also with a null or repeated id, is a
    document of its own; other columns are ignored.  A text beyond
    `segment_bytes` is cut between words; memory follows that size, not the
    length of a text or of a word's list.
    """
    schema = "segment long, base long, offset long, least long, term string, positions array<int>, row long, doc_id long, n_words long"
    names = [c.split(" ")[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int32())] + [pa.int64()] * 3

    def records(known: dict) -> pa.RecordBatch:
        n = max((len(v) for v in known.values() if not isinstance(v, int)), default=0)
        cell = lambda v, t: pa.nulls(n, t) if v is None else pa.array(np.full(n, v), t) if isinstance(v, int) else v
        return pa.RecordBatch.from_arrays([cell(known.get(c), t) for c, t in zip(names, kinds, strict=True)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId() << 24
        for batch in batches:
            for a, b, raw, off in chunks(batch.column(1), segment_bytes):
                base = segment << 16
                if b - a == 1 and len(raw) > segment_bytes:
                    n, tail = 0, raw[:0]
                    for piece in _pieces(raw, segment_bytes):
                        buf = LOWER[np.concatenate([tail, piece])]
                        start, end, doc = split(buf, np.array([0, len(buf)]), GAP)
                        known = min(n, reach)
                        terms, places, _ = _segment(buf, start, end, doc, 1, reach)
                        yield records({"segment": segment, "base": base, "offset": n - known, "least": n, "term": terms, "positions": places})
                        segment, n = segment + 1, n + len(start) - known
                        tail = buf[start[-min(n, reach)] :] if n else buf[:0]
                    count = np.array([n])
                else:
                    buf = LOWER[raw]
                    start, end, doc = split(buf, off, GAP)
                    terms, places, count = _segment(buf, start, end, doc, b - a, reach)
                    yield records({"segment": segment, "base": base, "offset": 0, "least": 0, "term": terms, "positions": places})
                    segment += 1
                yield records({"row": pa.array(base + np.arange(b - a)), "doc_id": batch.column(0)[a:b], "n_words": pa.array(count.astype(np.int64))})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    stored = stash(texts.mapInArrow(work, schema), "positions")
    return Index(stored.filter("row is not null").select("row", "doc_id", "n_words"), stored.filter("term is not null").select(*names[:6]), reach)


def item_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), F.lit(WORDS), F.lit(0))


class Phrases:
    """The phrases of a slice of test items: every `width` consecutive words, or all words of an item that has fewer."""

    def __init__(self, items: list[str], words: list[list[str]], width: int) -> None:
        self.items, self.vocabulary = items, {}
        number = self.vocabulary.setdefault
        codes = [np.array([number(w, len(self.vocabulary)) for w in ws], np.int64) for ws in words]
        wide, item = [], []
        for i, c in enumerate(codes):
            n = max(1, len(c) - width + 1)
            c = np.concatenate([c, np.full(max(0, width - len(c)), -1)])
            wide.append(c[np.arange(n)[:, None] + np.arange(width)])
            item.append(np.full(n, i))
        self.term = np.concatenate(wide) if wide else np.zeros((0, width), np.int64)
        self.item = np.concatenate(item) if item else np.zeros(0, np.int64)
        self.size = (self.term >= 0).sum(1)


class Lists:
    """The lists of a segment for the words of a slice."""

    def __init__(self, table: pa.Table, phrases: Phrases) -> None:
        terms = table["term"].to_pylist()
        flat = table["positions"].combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        edge, values = flat.offsets.to_numpy(), flat.values.to_numpy()
        get = phrases.vocabulary.get
        self.starts = np.zeros(0, np.int64)
        lists = []
        for t, a, b in zip(terms, edge[:-1], edge[1:], strict=True):
            if t == "":
                self.starts = values[a:b].astype(np.int64)
            elif (code := get(t)) is not None:
                lists.append((code, values[a:b]))
        lists.sort(key=lambda x: x[0])
        self.count = np.zeros(len(phrases.vocabulary) + 1, np.int64)  # the last for places that a short phrase does not have
        for code, places in lists:
            self.count[code] = len(places)
        self.first = np.cumsum(self.count) - self.count
        self.places = np.concatenate([p for _, p in lists]).astype(np.int64) if lists else np.zeros(0, np.int64)
        code = np.repeat(np.arange(len(self.count)), self.count)
        self.keys = code << 32 | self.places

    def rare_first(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrases all of whose words occur, their words' offsets from the rarest to the most frequent, then none)."""
        n = np.where(phrases.term >= 0, self.count[phrases.term], 1 << 40)
        at = np.flatnonzero((n > 0).all(1))
        return at, np.argsort(n[at], axis=1, kind="stable")

    def rarest(self, phrases: Phrases, at: np.ndarray, order: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number within `at`, place) of the rarest word of each phrase, in steps."""
        term = phrases.term[at, order[:, 0]]
        total = np.cumsum(self.count[term])
        a = 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + STEP, "right")))
            n = self.count[term[a:b]]
            which = np.repeat(np.arange(a, b), n)
            yield which, self.places[np.repeat(self.first[term[a:b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            a = b

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        key = term << 32 | np.maximum(place, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (self.keys[at] == key) & (place >= 0)

    def next(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first place of a term at or after `place`; far away if there is none."""
        at = np.searchsorted(self.keys, term << 32 | np.maximum(place, 0))
        key = self.keys[np.minimum(at, len(self.keys) - 1)]
        return np.where((at < len(self.keys)) & (key >> 32 == term), key & 0xFFFFFFFF, 1 << 40)


def phrase_places(lists: Lists, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start, end) of every exact occurrence in a segment."""
    at, order = lists.rare_first(phrases)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for which, place in lists.rarest(phrases, at, order) if len(at) else ():
        place = place - order[which, 0]
        for j in range(1, order.shape[1]):
            offset = order[which, j]
            term = phrases.term[at[which], offset]
            keep = (term < 0) | lists.has(term, place + offset)
            which, place = which[keep], place[keep]
        found.append((at[which], place))
    phrase, start = (np.concatenate(x) for x in zip(*found, strict=True))
    return phrase, start, start + phrases.size[phrase]


def near_places(lists: Lists, phrases: Phrases, slack: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase, start, end): the shortest stretch around each place of a phrase's rarest word that holds
    all its words in any order and is at most `slack` words longer than the phrase."""
    at, order = lists.rare_first(phrases)
    found = set()
    for which, place in lists.rarest(phrases, at, order) if len(at) else ():
        room = phrases.size[at[which]] + slack
        for j in range(1, order.shape[1]):
            term = phrases.term[at[which], order[which, j]]
            keep = (term < 0) | (lists.next(term, place - room + 1) < place + room)
            which, place, room = which[keep], place[keep], room[keep]
        for w, p, r in zip(which.tolist(), place.tolist(), room.tolist(), strict=True):
            terms = sorted({*phrases.term[at[w]].tolist()} - {-1})
            near = []
            for t in terms:
                a, b = np.searchsorted(lists.keys, [t << 32 | max(p - r + 1, 0), t << 32 | (p + r)])
                near += [(int(k) & 0xFFFFFFFF, t) for k in lists.keys[a:b]]
            near.sort()
            held, left, best = dict.fromkeys(terms, 0), 0, None
            for end, t in near:
                held[t] += 1
                while all(held.values()):
                    begin, u = near[left]
                    if begin <= p <= end and end - begin < r and (best is None or end - begin < best[1] - best[0]):
                        best = begin, end
                    held[u] -= 1
                    left += 1
            if best:
                found.add((int(at[w]), best[0], best[1] + 1))
    cells = np.array(sorted(found), np.int64).reshape(-1, 3)
    return cells[:, 0], cells[:, 1], cells[:, 2]


Places = Callable[[Lists, Phrases], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _runs(row: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching stretches of the same row and item, merged."""
    if len(row) == 0:
        return row, item, start, end
    order = np.lexsort((start, item, row))
    row, item, start, end = row[order], item[order], start[order], end[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
    group = np.cumsum(new) - 1
    shift = group * (int(end.max()) + 1)
    reached = np.maximum.accumulate(end + shift)
    new[1:] |= (start + shift)[1:] > reached[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row)) - 1
    return row[at], item[at], start[at], reached[last] - shift[last]


def find(index: Index, items: DataFrame, places: Places, width: int, id_col: str, text_col: str, slice_bytes: int) -> DataFrame:
    """(row, item_id, start, end): merged stretches of matches per document and item; end is exclusive."""
    spark = items.sparkSession
    words = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item_id"), item_words(F.col(text_col)).alias("words"))
    step = PART_PHRASES
    parts = F.transform(
        F.sequence(F.lit(0), F.floor(F.greatest(F.size("words") - width, F.lit(0)) / step).cast("int")),
        lambda i: F.slice("words", i * step + 1, step + width - 1),
    )
    asked = cut(words.filter(F.size("words") > 0).distinct().select("item_id", F.explode(parts).alias("words")))
    size = asked.agg(F.sum(F.octet_length(F.array_join("words", " ")) + F.octet_length("item_id") + 16)).first()[0] or 0
    slices = max(1, math.ceil(size / slice_bytes))
    number = F.pmod(F.xxhash64("item_id", "words"), F.lit(slices))
    schema = "row long, item_id string, start long, end long"

    def matched(i: int) -> DataFrame:
        part = asked.filter(number == i)  # about slice_bytes
        table = part.toArrow()
        terms = part.select(F.explode("words").alias("term")).distinct().unionByName(spark.createDataFrame([("",)], "term string"))
        lists = index.postings.join(F.broadcast(terms), "term", "left_semi")
        shared = spark.sparkContext.broadcast((table["item_id"].to_pylist(), table["words"].to_pylist()))
        built: list[Phrases] = []  # a task builds them once

        def work(table):
            if not built:
                built.append(Phrases(*shared.value, width))
            phrases, lists = built[0], Lists(table, built[0])
            phrase, start, end = places(lists, phrases)
            base, offset, least = (table[c][0].as_py() for c in ("base", "offset", "least"))
            doc = np.searchsorted(lists.starts, start, "right") - 1
            start, end = (x - lists.starts[doc] + offset for x in (start, end))
            own = end > least
            row, item, start, end = _runs(base + doc[own], phrases.item[phrase[own]], start[own], end[own])
            names = pa.array(phrases.items, pa.string()).take(pa.array(item))
            return pa.table({"row": row, "item_id": names, "start": start, "end": end})

        return lists.groupBy("segment").applyInArrow(work, schema)

    return reduce(DataFrame.unionByName, map(matched, range(slices)))


def phrase_matches(
    index: Index, items: DataFrame, width: int = 10, id_col: str = "item_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """(row, item_id, start, end): stretches of a document covered by exact occurrences of an item's phrases.

    A phrase is `width` consecutive words of an item, or all words of an item
    that has fewer.  An item without words, or null, has none; equal items count
    once; a null item_id is the empty string.
    """
    if width > index.reach:
        raise ValueError("phrases are longer than the reach of the index")
    return find(index, items, phrase_places, width, id_col, text_col, slice_bytes)


def proximity_matches(
    index: Index, items: DataFrame, width: int = 10, slack: int = 5, id_col: str = "item_id", text_col: str = "text",
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(row, item_id, start, end): stretches that hold all words of one phrase of an item in any order, with up to `slack` others."""
    if width + slack > index.reach // 2:
        raise ValueError("stretches are longer than half the reach of the index")
    return find(index, items, lambda lists, phrases: near_places(lists, phrases, slack), width, id_col, text_col, slice_bytes)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    width: int = 10,
    slack: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    reach: int = REACH,
    segment_bytes: int = SEGMENT_BYTES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_hit, items, spans, contaminated), one row per input row.

    items: the ids, as sorted strings, of test items with a phrase in the
    document (with `slack`, with all words of a phrase near each other); spans:
    the merged stretches (start, end) of words that matches cover, of n_hit words
    together.  Words are lower-cased (A-Z) runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`.

    A null or empty text, on either side, has no words; rows with a null or
    repeated doc_id, and repeated rows, are documents of their own; a null item_id
    is the empty string, items that share an id are one item with several texts;
    very long texts are dealt over segments that overlap; an empty table of
    documents gives no rows, one of items no hits; other columns are ignored.
    """
    index = build_index(docs, id_col, text_col, reach, segment_bytes)
    if slack is None:
        found = phrase_matches(index, items, width, item_col, item_text_col, slice_bytes)
    else:
        found = proximity_matches(index, items, width, slack, item_col, item_text_col, slice_bytes)
    # stretches of different items in one document, merged
    before = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("new", (F.col("start") > F.max("end").over(before)).cast("int"))
    found = found.withColumn("run", F.coalesce(F.sum("new").over(upto), F.lit(0)))
    runs = found.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.collect_set("item_id").alias("items"))
    per_row = runs.groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
    )
    out = index.rows.join(per_row, "row", "left")
    nothing = F.expr("cast(array() as array<struct<start:bigint,end:bigint>>)")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("spans", nothing).alias("spans"),
        F.col("spans").isNotNull().alias("contaminated"),
    )
