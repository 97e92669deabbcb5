"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Both tokenizers spell the same bytes, so their tokens are two ways of cutting
one byte string.  An interval of it is divided at a place where a token of
either kind ends: the first such place next to the interval's middle, found by
a binary search of the one's ends among the other's, at growing distance where
the middle has none.  Both halves are divided in turn; an interval without a
common end is a leaf, a group of tokens that belong together.  All intervals of
a level are divided at once, over many documents.

Every pair of ids that overlap in a document is counted once for it.  The
counts grow with the corpus, so they stay a table: each chunk of documents asks
for the counts of its own distinct pairs and gets them back, one row a chunk
however many documents hold a pair.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import CACHE_CHARS, Bpe, default_vocabulary
from .common import stash

#: Characters that one numpy step takes, and to a part of a long text.
STEP_CHARS = 1 << 18
PART_CHARS = 1 << 18
#: Ends that are tried at a time around the middles of intervals.
RING = 1 << 16
#: Characters of documents that ask for counts together.
CHUNK_CHARS = 2 << 20

_MARK = "▁"
#: Where both tokenizers always cut: before a space that follows other than white space.
_CUT = re.compile(r"(?<=\S) ")


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Words(Bpe):
    """A byte-level BPE for texts of many rare words: a compiled encoder proposes a word's tokens, and they stand
    where every two neighbours are compatible, which makes them the result of the merges."""

    def __init__(self, spec: str) -> None:
        super().__init__(spec)
        ranks = {t.encode("latin-1"): i for i, t in enumerate(self.text)}
        self.propose = tiktoken.Encoding("merges", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def merge(self, piece: str) -> list[int]:
        if len(piece) > CACHE_CHARS:
            return super().merge(piece)
        found = self.propose(piece.encode("latin-1").decode("utf-8"))
        last, known = -1, self.known
        for t in found:
            if last >= 0:
                fits = known.get(last << 32 | t)
                if not (self.compatible(last, t) if fits is None else fits):
                    return super().merge(piece)
            last = t
        return found


class Pieces:
    """A sentencepiece vocabulary: ids of a text that begins with the space put before it, and the bytes of each id."""

    def __init__(self, spec: bytes) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=spec)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        # where no piece goes on after a space, words are merged each for itself, and a text may be cut between them
        self.by_word = not any(_MARK in p.lstrip(_MARK) for p in pieces)
        self.bytes = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text[1:]), np.int32)


class Spelling:
    """Bytes and decimal digits of ids, for arrays of them."""

    def __init__(self, by_id: list[bytes]) -> None:
        self.length = np.array([len(b) for b in by_id], np.int64)
        self.offset = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        self.digits = np.array([str(i).encode() for i in range(len(by_id))])
        width = self.digits.dtype.itemsize
        self.digits = self.digits.view(np.uint8).reshape(-1, width)
        self.n_digits = (self.digits != 0).sum(1)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.length[ids]
        return self.flat[np.repeat(self.offset[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())].tobytes()


def shared_cuts(a: np.ndarray, b: np.ndarray, a_edge: np.ndarray, b_edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of either side that end where one of the other ends, rising.

    `a` and `b` are rising ends in one numbering of bytes, `a_edge` and `b_edge`
    the tokens at which the intervals to divide begin, and their ends.
    """
    lo, hi, blo, bhi = a_edge[:-1], a_edge[1:], b_edge[:-1], b_edge[1:]
    full = hi > lo
    lo, hi, blo, bhi = lo[full], hi[full], blo[full], bhi[full]
    cuts_a, cuts_b = [hi - 1], [bhi - 1]
    while True:
        more = (hi - lo > 1) & (bhi - blo > 1)
        lo, hi, blo, bhi = lo[more], hi[more], blo[more], bhi[more]
        if len(lo) == 0:
            break
        first = np.where(lo > 0, a[lo - 1], 0)
        middle = np.clip(np.searchsorted(a, (first + a[hi - 1]) // 2), lo, hi - 2)
        cut = np.full(len(lo), -1)
        at = np.searchsorted(b, a[middle])
        hit = b[at] == a[middle]
        cut[hit] = middle[hit]
        open_, reach, width = np.flatnonzero(~hit), 0, 1
        while len(open_):
            # the ends at distances reach+1 to reach+width to either side, nearest first
            side = np.arange(reach + 1, reach + width + 1)
            side = np.stack([side, -side], 1).ravel()
            try_ = middle[open_][:, None] + side
            inside = (try_ >= lo[open_][:, None]) & (try_ <= hi[open_][:, None] - 2)
            row, col = np.nonzero(inside)
            ends = a[try_[row, col]]
            same = b[np.searchsorted(b, ends)] == ends
            row, col = row[same], col[same]
            new = np.ones(len(row), bool)
            new[1:] = row[1:] != row[:-1]
            cut[open_[row[new]]] = try_[row[new], col[new]]
            reach, width = reach + width, min(2 * width, max(1, RING // len(open_)))
            left = (cut[open_] < 0) & ((middle[open_] + reach + 1 <= hi[open_] - 2) | (middle[open_] - reach - 1 >= lo[open_]))
            open_ = open_[left]
        found = cut >= 0
        lo, hi, blo, bhi, cut = lo[found], hi[found], blo[found], bhi[found], cut[found]
        other = np.searchsorted(b, a[cut])
        cuts_a.append(cut)
        cuts_b.append(other)
        # in order, so that the next searches walk the ends from left to right
        lo, hi = np.stack([lo, cut + 1], 1).ravel(), np.stack([cut + 1, hi], 1).ravel()
        blo, bhi = np.stack([blo, other + 1], 1).ravel(), np.stack([other + 1, bhi], 1).ravel()
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


class Aligner:
    def __init__(self, a_spec: str, b_spec: bytes) -> None:
        self.a, self.b = Words(a_spec), Pieces(b_spec)
        n = len(self.a.length)
        self.a_spelling = Spelling([self.a.flat[o : o + s].tobytes() for o, s in zip(self.a.offset, self.a.length, strict=True)])
        self.b_spelling = Spelling(self.b.bytes)
        self.n_ids = max(n, len(self.b.bytes))

    def encode(self, part: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text that begins with a space; special tokens' strings are plain text."""
        return np.frombuffer(b"".join(map(self.a.seen.__getitem__, self.a.pieces(part))), np.int32), self.b.encode(part)

    def parts(self, text: str, size: int) -> Iterator[str]:
        """A text in parts of about `size` characters, cut where both tokenizers always cut."""
        a = 0
        while self.b.by_word and len(text) - a > size:
            at = _CUT.search(text, a + size)
            if at is None:
                break
            yield text[a : at.start()]
            a = at.start()
        yield text[a:]

    def align(self, parts: list[str]) -> tuple[np.ndarray, ...] | None:
        """Of all parts: (a_ids, b_ids, a_edge, b_edge, cuts in a, cuts in b), or None where some part's tokens spell other bytes."""
        pairs = [self.encode(p) for p in parts]
        a_ids, b_ids = (np.concatenate([p[i] for p in pairs]) if pairs else np.zeros(0, np.int32) for i in (0, 1))
        raw = "".join(parts).encode("utf-8", "replace")
        if self.a_spelling.joined(a_ids) != raw or self.b_spelling.joined(b_ids) != raw:
            return None
        a_edge, b_edge = (np.concatenate([[0], np.cumsum([len(p[i]) for p in pairs])]).astype(np.int64) for i in (0, 1))
        # 32 bits: a step holds little more than STEP_CHARS, or one part
        a, b = (np.cumsum(x.length[i]).astype(np.int32) for x, i in ((self.a_spelling, a_ids), (self.b_spelling, b_ids)))
        last = lambda ends, edge: np.where(edge > 0, ends[np.maximum(edge, 1) - 1], 0) if len(ends) else edge * 0
        if (last(a, a_edge) != last(b, b_edge)).any():
            return None
        return (a_ids, b_ids, a_edge, b_edge, a, b, *shared_cuts(a, b, a_edge, b_edge))

    def groups_text(self, a_ids: np.ndarray, b_ids: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, group_edge: np.ndarray):
        """`a1,a2|b1;` of every group as bytes, and where each part's begin and end."""
        n_a, n_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        group_a, group_b = (np.repeat(np.arange(len(n)), n) for n in (n_a, n_b))
        at_a = np.arange(len(a_ids)) + (np.cumsum(n_b) - n_b)[group_a]
        at_b = np.arange(len(b_ids)) + np.cumsum(n_a)[group_b]
        a_digits, b_digits = self.a_spelling.digits, self.b_spelling.digits
        width = max(a_digits.shape[1], b_digits.shape[1])
        cells, used = np.zeros((len(a_ids) + len(b_ids), width + 1), np.uint8), np.empty(len(a_ids) + len(b_ids), np.int64)
        cells[at_a, : a_digits.shape[1]], cells[at_b, : b_digits.shape[1]] = a_digits[a_ids], b_digits[b_ids]
        used[at_a], used[at_b] = self.a_spelling.n_digits[a_ids], self.b_spelling.n_digits[b_ids]
        cells[:, width] = ord(",")
        cells[at_a[cut_a], width] = ord("|")
        cells[at_b[cut_b], width] = ord(";")
        ends = np.concatenate([[0], np.cumsum(used + 1)])
        token = np.concatenate([[0], np.cumsum(n_a + n_b)])[group_edge]
        return cells.tobytes().translate(None, b"\0"), ends[token].tolist()


_built: list[tuple[str, Aligner]] = []


def aligner(a_spec: str, b_spec: bytes) -> Aligner:
    """The tables of two vocabularies; a worker process builds them once."""
    key = hashlib.sha256(a_spec.encode() + b_spec).hexdigest()
    if not _built or _built[0][0] != key:
        _built[:] = [(key, Aligner(a_spec, b_spec))]
    return _built[0][1]


class Doc:
    """What is known so far of a document whose parts are being aligned."""

    def __init__(self, number: int) -> None:
        self.number, self.n_a, self.n_b, self.n_groups, self.bad = number, 0, 0, 0, False
        self.n_links, self.sha, self.tail, self.groups = 0, hashlib.sha256(), b"", []


def _distinct(doc: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, pair) and how often each occurs."""
    order = np.lexsort((pair, doc))
    doc, pair = doc[order], pair[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (pair[1:] != pair[:-1])
    at = np.flatnonzero(new)
    return doc[at], pair[at], np.add.reduceat(times[order], at) if len(at) else times[:0]


OUT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def alignments(
    docs: DataFrame,
    a_vocabulary: str | None = None,
    b_vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: bool = False,
) -> DataFrame:
    """Every document's alignment and its distinct linked pairs, in chunks.

    (chunk, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, place, times, pairs, holders)
    and, if asked, `groups` (the groups as text).  pairs (ids a << 32 | b) and
    holders (documents that hold them) stand in the first row of a chunk; place
    and times are packed 32-bit numbers: the document's pairs by their place in
    that list, and how often each is linked.
    """
    context = docs.sparkSession.sparkContext
    with open(a_vocabulary or default_vocabulary(), encoding="utf-8") as f, open(b_vocabulary or default_pieces(), "rb") as g:
        shared = context.broadcast((f.read(), g.read()))  # vocabulary files, a few MB
    schema = f"chunk long, doc_id long, {OUT}, place binary, times binary, pairs array<long>, holders array<int>" + ", groups string" * groups

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(*shared.value)
        state = {"chunk": TaskContext.get().partitionId() << 32, "chars": 0}
        ids: list = []  # of the chunk's documents
        done: list[Doc] = []
        links: list[tuple] = []  # (document, pair, times) arrays
        parts: list[tuple[Doc, str]] = []

        def step() -> None:
            texts = [p for d, p in parts if not d.bad]
            owners = [d for d, _ in parts if not d.bad]
            parts.clear()
            found = tool.align(texts)
            if found is None:
                for d, p in zip(owners, texts, strict=True):
                    if not d.bad and tool.align([p]) is None:
                        d.bad = True
                kept = [(d, p) for d, p in zip(owners, texts, strict=True) if not d.bad]
                owners = [d for d, _ in kept]
                found = tool.align([p for _, p in kept])
            a_ids, b_ids, a_edge, b_edge, a, b, cut_a, cut_b = found
            group_edge = np.searchsorted(cut_a, a_edge)
            text, edge = tool.groups_text(a_ids, b_ids, cut_a, cut_b, group_edge)
            every = np.sort(np.concatenate([a, b]))
            every = every[np.diff(every, prepend=-1) > 0]  # each stretch between two ends is one link
            at_a, at_b = np.searchsorted(a, every), np.searchsorted(b, every)
            pair = a_ids[at_a].astype(np.int64) << 32 | b_ids[at_b]
            part = np.searchsorted(a_edge, at_a, "right") - 1
            number = np.array([d.number for d in owners], np.int64)
            links.append(_distinct(number[part], pair, np.ones(len(pair), np.int64)))
            per_part = np.bincount(part, minlength=len(owners))
            for i, d in enumerate(owners):
                d.n_a += int(a_edge[i + 1] - a_edge[i])
                d.n_b += int(b_edge[i + 1] - b_edge[i])
                d.n_groups += int(group_edge[i + 1] - group_edge[i])
                d.n_links += int(per_part[i])
                if edge[i + 1] > edge[i]:
                    d.sha.update(d.tail)
                    d.sha.update(text[edge[i] : edge[i + 1] - 1])
                    d.tail = b";"
                    if groups:
                        d.groups.append(text[edge[i] : edge[i + 1] - 1].decode())

        def flush() -> pa.RecordBatch:
            good = np.array([not d.bad for d in done], bool)
            doc, pair, times = _distinct(*(np.concatenate([x[i] for x in links]) for i in range(3))) if links else (np.zeros(0, np.int64),) * 3
            keep = good[doc]
            doc, pair, times = doc[keep], pair[keep], times[keep]
            known, place = np.unique(pair, return_inverse=True)
            edge = np.searchsorted(doc, np.arange(len(done) + 1))
            packed = lambda x: [x[u:v].astype(np.int32).tobytes() for u, v in zip(edge[:-1], edge[1:], strict=True)]
            only_first = lambda x: [x, *[None] * (len(done) - 1)]
            number = lambda f: pa.array([0 if d.bad else f(d) for d in done], pa.int64())
            cells = [
                pa.array(np.full(len(done), state["chunk"])),
                pa.array(ids, pa.int64()),
                *(number(f) for f in (lambda d: d.n_a, lambda d: d.n_b, lambda d: d.n_groups, lambda d: d.n_links)),
                pa.array(["" if d.bad or not d.n_a else d.sha.hexdigest() for d in done], pa.string()),
                pa.array(packed(place), pa.binary()),
                pa.array(packed(times), pa.binary()),
                pa.array(only_first(known), pa.list_(pa.int64())),
                pa.array(only_first(np.bincount(place, minlength=len(known)).astype(np.int32)), pa.list_(pa.int32())),
            ]
            if groups:
                cells.append(pa.array(["" if d.bad else ";".join(d.groups) for d in done], pa.string()))
            for x in (ids, done, links):
                x.clear()
            state["chunk"], state["chars"] = state["chunk"] + 1, 0
            return pa.RecordBatch.from_arrays(cells, [c.strip().split(" ")[0] for c in schema.split(",")])

        waiting = 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                text = text.as_py()
                d = Doc(len(done))
                done.append(d)
                ids.append(i.as_py())
                if text:
                    for p in tool.parts(" " + text, PART_CHARS):
                        parts.append((d, p))
                        waiting += len(p)
                        if waiting >= STEP_CHARS:
                            step()
                            waiting = 0
                    state["chars"] += len(text)
                if state["chars"] >= CHUNK_CHARS:
                    step()
                    waiting = 0
                    yield flush()
        if done:
            step()
            yield flush()

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(work, schema)


def cross_align(
    docs: DataFrame,
    a_vocabulary: str | None = None,
    b_vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    groups: bool = False,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]), one row per input row.

    A is a byte-level BPE (tokenizers JSON) of space + text, B a sentencepiece
    vocabulary of text, which puts the space itself; both paths are files on the
    driver.  groups writes the tokens between common ends as `a1,a2|b1;a3|b2,b3`.
    A link is an occurrence of overlapping tokens; the count of a pair of ids is
    the number of documents that link it, n_best counts links whose count is the
    highest of their A id, count_sum adds the counts of all links.

    A null or empty text, or one that either side's tokens do not spell back (a
    text with U+2581), has no tokens: zeros, and the empty string for
    groups_sha256.  Very long texts are taken in parts, cut where both always
    cut; a null doc_id stays null; rows with repeated ids, and repeated rows, are
    documents of their own, also in the counts; an empty table gives no rows;
    other columns are ignored.
    """
    aligned = stash(alignments(docs, a_vocabulary, b_vocabulary, id_col, text_col, groups), "aligned")
    held = aligned.filter(F.size("pairs") > 0).select("chunk", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "x"))
    held = held.select("chunk", "place", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    counts = stash(held.groupBy("pair").agg(F.sum("holders").alias("count")), "pairs").withColumn("a", F.shiftright("pair", 32))
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    ranked = counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    answers = held.join(ranked, "pair").select(F.col("chunk").alias("of"), "place", "count", "best")
    fixed = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    rest = ["groups_sha256"] + ["groups"] * groups
    mine = aligned.select("chunk", *fixed, "place", "times", *rest)

    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        n = answers.num_rows
        count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        at = answers["place"].to_numpy()
        count[at], best[at] = answers["count"].to_numpy(), answers["best"].to_numpy().astype(np.int64)
        n_best, total = [], []
        for place, times in zip(docs["place"], docs["times"], strict=True):
            place, times = np.frombuffer(place.as_buffer(), np.int32), np.frombuffer(times.as_buffer(), np.int32).astype(np.int64)
            n_best.append(int(times @ best[place]))
            total.append(int(times @ count[place]))
        return pa.table(
            [*(docs[c] for c in fixed), pa.array(n_best, pa.int64()), pa.array(total, pa.int64()), *(docs[c] for c in rest)],
            [*fixed, "n_best", "count_sum", *rest],
        )

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return mine.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(work, schema + ", groups string" * groups)
