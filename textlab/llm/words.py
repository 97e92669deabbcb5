"""Words, rolling hashes and hash mixing over the raw bytes of many documents at once (numpy).

A hash of a byte range is a difference of prefix sums of a polynomial modulo
2**64 over a fixed random byte table, so any range costs two look-ups.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_STEP = U(0x9E3779B97F4A7C15)
_BACK = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(1_234_577).integers(1, 1 << 63, 256, dtype=np.uint64) | U(1)

#: Bytes that separate words for `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the step and of its inverse."""
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, 1 << 16, 2 * len(_powers))
        grow = lambda base: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
        _powers, _inverse = grow(_STEP), grow(_BACK)
    return _powers, _inverse


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    z = x + U(salt * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums for `ranges`, of 64-bit symbols."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(len(values))[0][: len(values)], out=out[1:])
    return out


def byte_prefix(buf: np.ndarray) -> np.ndarray:
    return prefix(_BYTE[buf])


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the ranges [start, end), equal for equal contents wherever they stand."""
    inverse = powers(len(sums))[1]
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def split(buf: np.ndarray, off: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each word: a maximal run of bytes that are no gap, within one document."""
    inside = ~gap[buf]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = off[1:] > off[:-1]
    first, last = off[:-1][full], off[1:][full] - 1
    start[first], end[last] = inside[first], inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(off, starts, "right") - 1


def word_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return ranges(byte_prefix(buf), start, end)


def shingles(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every k consecutive words; a document with fewer words, but some, has its whole sequence as one."""
    n = len(words)
    count = np.bincount(doc, minlength=n_docs)
    sums = prefix(words)
    at = np.arange(max(0, n - k + 1))
    at = at[doc[at] == doc[at + k - 1]]
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < k))
    hashes = np.concatenate([ranges(sums, at, at + k), ranges(sums, first[short], first[short] + count[short])])
    return hashes, np.concatenate([doc[at], short])


def distinct(hashes: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document in (document, hash) order, and where each document's begin."""
    order = np.argsort(hashes)
    order = order[np.argsort(doc[order].astype(np.uint16 if n_docs < 1 << 16 else np.int64), kind="stable")]
    h, d = hashes[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[keep], d[keep]
    return h, np.searchsorted(d, np.arange(n_docs + 1))
