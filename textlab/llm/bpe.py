"""Byte-pair encoding by backtracking over longest token matches; decoding by an offset table.

A token sequence is the result of the merges exactly when every two neighbours
are compatible, that is, when re-encoding their joint bytes gives the same two
tokens.  Compatibility is decided by walking the merge table from the joint
outwards and remembered per pair.  The encoder takes the longest match that an
Aho-Corasick automaton finds at each place, shortens it while it is not
compatible with the token before, and steps back where nothing fits; places
found to be dead ends are not entered again, so the time is linear.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

#: Pieces of text whose tokens a worker remembers (twice over: those of late and those of before), and the longest such piece.
CACHE_PIECES = 300_000
CACHE_CHARS = 40

# Character classes of U+0000 to U+00FF for the usual split into contractions,
# letters, numbers, other signs and white space.
_L, _N, _S = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
_SPLIT = re.compile(rf" ?[{_L}]+| ?[{_N}]+|'(?:[stmd]|re|ve|ll)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_WIDE = re.compile("[^\x00-\xff]")


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Bpe:
    """Tables of one byte-level BPE vocabulary. Inside, tokens are numbered by rank: bytes first, then merges in order."""

    def __init__(self, spec: str) -> None:
        data = json.loads(spec)
        model, pre = data["model"], data["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or not pre["use_regex"] or data["normalizer"]:
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        self.prefix_space = pre["add_prefix_space"]
        self.pre = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        chars = byte_chars()
        back = {c: chr(b) for b, c in enumerate(chars)}
        plain = lambda s: "".join(back[c] for c in s)  # noqa: E731  one char per byte
        self.text = [chr(b) for b in range(256)]
        self.left, self.right = list(range(256)), list(range(256))
        rank, ids = {c: i for i, c in enumerate(self.text)}, [model["vocab"][chars[b]] for b in range(256)]
        self.pair: dict[tuple[int, int], int] = {}
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            x, y = rank[plain(a)], rank[plain(b)]
            token = self.text[x] + self.text[y]
            if token in rank:
                raise ValueError("two merges make the same token")
            self.pair[x, y] = rank[token] = len(self.text)
            self.text.append(token)
            self.left.append(x)
            self.right.append(y)
            ids.append(model["vocab"][a + b])
        self.rank, self.ids = rank, np.array(ids, np.int32)
        self.shorter = [next((rank[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in rank), -1) for t in self.text]
        self.size = [len(t) for t in self.text]
        self.auto = ahocorasick.Automaton()
        for t, i in rank.items():
            self.auto.add_word(t, i)
        self.auto.make_automaton()
        self.known: dict[int, bool] = {}
        self.seen: dict[str, bytes] = _Pieces(self)
        # special tokens are cut out of the text before it is split
        special = {}
        for t in data["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError("special tokens that take in their surroundings are not supported")
            special[t["content"]] = t["id"]
        self.special = special
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) + ")") if special else None
        # decoding: all tokens' bytes in a row, and where each id's begin
        n = max([*ids, *special.values()]) + 1
        by_id = [b""] * n
        for i, t in zip(ids, self.text, strict=True):
            by_id[i] = t.encode("latin-1")
        for t, i in special.items():
            by_id[i] = "".join(back.get(c, c) for c in t).encode("latin-1") if all(back.get(c, c) <= "\xff" for c in t) else t.encode()
        self.length = np.array([len(t) for t in by_id], np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)[:-1]])
        self.flat = np.frombuffer(b"".join(by_id), np.uint8)
        width = len(str(n)) + 1
        self.decimal = np.array([f"{i},".encode().ljust(width, b"\0") for i in range(n)], f"S{width}").view(np.uint8).reshape(n, width) if n else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart when their joint bytes are merged by rank."""
        key = a << 32 | b
        known = self.known.get(key)
        if known is None:
            if len(self.known) > 2_000_000:
                self.known.clear()
            known = self.known[key] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        """The later-made of the two tokens at the joint is taken apart step by step;
        a merge across the joint that comes before both were complete would have won."""
        pair, left, right = self.pair, self.left, self.right
        limit = len(self.text)
        while True:
            if pair.get((a, b), limit) < limit:
                return False
            if a > b:
                limit, a = a, right[a]
                if a != limit:
                    continue
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 != limit:
                    continue
                limit, a = a, right[a]
                if a == limit:
                    return True

    def merge(self, piece: str) -> list[int]:
        """Ranks of a piece's tokens; one char per byte."""
        n, size, known = len(piece), self.size, self.known
        first = self.matches(piece)
        found: list[int] = []
        dead = set()
        at, last, t = 0, -1, first[0]
        while True:
            end = at + size[t]
            if end not in dead:
                fits = last < 0 or known.get(last << 32 | t)
                if fits is None:
                    fits = self.compatible(last, t)
                if fits:
                    found.append(t)
                    if end == n:
                        return found
                    at, last = end, t
                    t = first[at]
                    continue
            t = self.shorter[t]
            if t < 0:
                dead.add(at)
                t = found.pop()
                at -= size[t]
                last = found[-1] if found else -1

    def matches(self, piece: str) -> list[int]:
        """The longest token that begins at each place."""
        size, found, top = self.size, [0] * len(piece), [0] * len(piece)
        for end, t in self.auto.iter(piece):
            n = size[t]
            start = end + 1 - n
            if n > top[start]:
                top[start], found[start] = n, t
        return found

    def pieces(self, text: str) -> list[str]:
        if not _WIDE.search(text):
            return _SPLIT.findall(text)
        return [text[a:b] for _, (a, b) in self.pre.pre_tokenize_str(text)]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, without special tokens added; those in the text count as such."""
        if not self.special or not self.cut.search(text):
            parts = [text]
        else:
            parts = self.cut.split(text)
        out = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(np.int32(self.special[part]).tobytes())
            elif part:
                if self.prefix_space and not part[0].isspace():
                    part = " " + part
                out.append(b"".join(map(self.seen.__getitem__, self.pieces(part))))
        return np.frombuffer(b"".join(out), np.int32)

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.length[ids]
        begin = np.cumsum(sizes) - sizes
        at = np.repeat(self.offset[ids] - begin, sizes)
        at += np.arange(len(at))
        raw = self.flat[at].tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw

    def joined(self, ids: np.ndarray) -> bytes:
        """Decimal ids joined by commas."""
        cells = self.decimal[ids].ravel()
        return cells[cells != 0].tobytes()[:-1]


class _Pieces(dict):
    """Remembered ids of short pieces, as bytes of int32; pieces in use outlast the others."""

    def __init__(self, bpe: Bpe) -> None:
        super().__init__()
        self.bpe, self.old = bpe, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ranks = self.bpe.merge(piece.encode("utf-8", "replace").decode("latin-1"))
            ids = self.bpe.ids[ranks].tobytes()
            if len(piece) > CACHE_CHARS:
                return ids
        if len(self) >= CACHE_PIECES:
            self.old = dict(self)
            self.clear()
        self[piece] = ids
        return ids


_built: dict[str, Bpe] = {}


def tables(spec: str) -> Bpe:
    """The tables of a vocabulary; a worker process builds them once."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _built:
        _built.clear()
        _built[key] = Bpe(spec)
    return _built[key]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_TYPES = {"n_tokens": "long", "ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def bpe_encode(
    docs: DataFrame,
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, *outputs): each text's tokens.

    `outputs` picks from n_tokens, ids, decoded (the text that the ids give
    back), ids_sha256 (of decimal ids joined by commas) and decoded_sha256.
    `vocabulary` is the path of a tokenizers JSON file on the driver; a few MB
    that are sent to the tasks, whatever the size of the data.  One row per
    input row, repeated rows included; a null text is empty (no tokens); a null
    doc_id stays null; an empty table gives no rows; other columns are ignored.
    No shuffle.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = ", ".join(["doc_id long", *(f"{c} {_TYPES[c]}" for c in outputs)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tables(shared.value)
        for batch in batches:
            rows: dict[str, list] = {c: [] for c in outputs}
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                raw = bpe.decode_bytes(ids) if {"decoded", "decoded_sha256"} & rows.keys() else b""
                for c, cells in rows.items():
                    if c == "n_tokens":
                        cells.append(len(ids))
                    elif c == "ids":
                        cells.append(ids)
                    elif c == "decoded":
                        cells.append(raw.decode())
                    elif c == "ids_sha256":
                        cells.append(hashlib.sha256(bpe.joined(ids)).hexdigest())
                    else:
                        cells.append(hashlib.sha256(raw).hexdigest())
            kinds = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, kinds.get(c, pa.string())) for c, v in rows.items())], ["doc_id", *rows]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(work, schema)


def bpe_decode(encoded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from arrays of ids; null or empty ids give the empty text, an unknown id is an error."""
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as f:
        shared = encoded.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tables(shared.value)
        for batch in batches:
            out = [bpe.decode_bytes(np.array(x.as_py() or [], np.int32)).decode() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        work, "doc_id long, text string"
    )
