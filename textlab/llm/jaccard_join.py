"""N-gram Jaccard join by universe partition and the pigeonhole principle.

Documents are sets of hashed word shingles.  Sizes fall into bands such that the
partners of a set lie in its own band or the next; band b's scheme serves pairs
whose smaller set lies in b.  A scheme deals the universe of shingles into
segments by hash.  Two sets that link differ in D shingles at most, D following
from the band, so with segments to spare some must agree:

* with D + 1 + x segments, at least 1 + x of them agree.  A set may thus leave
  out up to x empty segments; one with more of them gives those, too.
* with fewer, larger segments, some agree up to one shingle: p segments that
  allow one deletion and q that allow none suffice if 2p + q > D.  A set then also
  gives each deletion of one shingle from the p segments.

Each band takes the allocation of least cost: signatures, and the chance that
segments agree for being (nearly) empty.  Sets that share a signature are
candidates and are verified by exact intersection of their hashed shingles.

Equal sets are one node.  Nodes under one signature are compared by size and by
parity sketches (each shingle turns one bit; sets that differ in D shingles differ
in D bits at most), which rules out pairs without error.  In a few rounds each
node's nearest such partner in another component is verified, which links most
groups; then every pair that is left under one signature in different components
is, so no link between components is missed, while pairs within a component known
already are never listed.  Small sketches tell which rows have a possible partner, and those
are compared again by sketches four times as long, which leave few pairs that do not link.  Signatures with very many nodes are dealt in tiles of bounded size.
Near copies share many signatures; rows list the signatures that their nodes have next before, and two that have
one of them in common leave their pair to it, so that a pair is not given once per signature and partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, components, cut, stash
from .license_scan import LOWER
from .repeats import DOC, ordered_texts
from .words import U, distinct, mix, shingles, split, word_hashes

K = 4
#: Two sets link when den * intersection >= num * union.
NUM, DEN = 85, 100
#: Cost of a (nearly) empty segment, in signatures.
EMPTY_COST = 64
_STEP = U(0xD6E8FEB86659FD93)
#: Shingles to a 64-bit word of a sketch and of a fine sketch, and its fewest words; the number of words is a power of two.
SKETCH_LOAD, FINE_LOAD, SKETCH_LEAST = 100, 25, 4
#: Expected nodes in a tile's side.
TILE = 2048
#: Signatures to a row's list of those that its node has next before, in their order.
BEFORE = 16
#: Words of sketches that are compared at a time.
CELLS = 1 << 21
#: Document keys (three numbers each) of at most so many candidates are sent to the texts; more are joined by a shuffle.
KEYS_BROADCAST = 500_000
#: Rounds that verify each node's nearest partner only; one that verifies all that is left follows.
ROUNDS = 3


@lru_cache(maxsize=None)
def bands(num: int, den: int, top: int) -> np.ndarray:
    """Least sizes of the bands, beyond `top`."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * den // num + 1)
    return np.array(out, np.int64)


@lru_cache(maxsize=None)
def scheme(num: int, den: int, low: int, high: int) -> tuple[int, int, int]:
    """(segments, of them with one deletion, empty segments to leave out) for smaller sizes in [low, high).

    With deletions every segment counts, empty or not.
    """
    a = high - 1
    d = (a + a * den // num) * (den - num) // (den + num)
    p = (d + 1) // 2
    q = d + 1 - 2 * p
    n = (low + a) / 2
    one = (p + q) + n * p / (p + q) + EMPTY_COST * (p + q) * math.exp(-n / (p + q))
    x = 0
    while True:
        m = d + 1 + x
        mean = m * math.exp(-n / m)
        more = 1 - sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(x + 1))
        if more < 1e-4 or x >= 12:
            break
        x += 1
    zero = m + EMPTY_COST * mean
    return (p + q, p, 0) if one < zero or d == 0 else (m, 0, x)


def doc_sets(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in document order, and where each document's begin."""
    n = len(off) - 1
    lower = LOWER[buf]
    start, end, doc = split(lower, off)
    h, d = shingles(word_hashes(lower, start, end), doc, n, k)
    return distinct(h, d, n)


def nodes_of(h: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A name of each document's set; 0 for the empty set."""
    size = np.diff(edge)
    sums = np.zeros(len(size), np.uint64)
    full = size > 0
    if full.any():
        sums[full] = np.add.reduceat(mix(h, 61), edge[:-1][full])
    return np.where(full, mix(sums + size.astype(np.uint64) * _STEP, 63) | U(1), U(0))


def signatures(h: np.ndarray, edge: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document) rows."""
    size = np.diff(edge)
    if len(h) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lows = bands(num, den, int(size.max()))
    band = np.searchsorted(lows, size, "right") - 1
    out_sig, out_doc = [], []
    value = mix(h, 71)
    for back in (0, 1):
        docs = np.flatnonzero((size > 0) & (band >= back))
        if len(docs) == 0:
            continue
        b = band[docs] - back
        plan = np.array([scheme(num, den, int(lows[i]), int(lows[i + 1])) for i in range(int(b.max()) + 1)], np.int64)[b]
        m, p, x = plan.T
        n = size[docs]
        at = np.repeat(edge[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        base = np.cumsum(m) - m
        segment = ((mix(h[at], 73) >> U(20)) % np.repeat(m, n).astype(np.uint64)).astype(np.int64)
        cell = np.repeat(base, n) + segment
        total = int(m.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, cell, value[at])
        filled = np.bincount(cell, minlength=total) > 0
        owner = np.repeat(np.arange(len(docs)), m)
        number = np.arange(total) - base[owner]
        salt = mix(b.astype(np.uint64) * U(1 << 32) + U(1), 77)
        name = lambda s, cells: mix(s + mix(salt[owner[cells]] + number[cells].astype(np.uint64), 79), 83)
        empties = m - np.bincount(owner, filled, minlength=len(docs)).astype(np.int64)
        give = np.flatnonzero(filled | ((p > 0) | (empties > x))[owner])
        out_sig.append(name(sums[give], give))
        out_doc.append(docs[owner[give]])
        cut = np.flatnonzero(segment < np.repeat(p, n))
        if len(cut):
            cells = cell[cut]
            out_sig.append(name(sums[cells] - value[at[cut]], cells))
            out_doc.append(docs[owner[cells]])
    return np.concatenate(out_sig), np.concatenate(out_doc)


def sketch_words(size: np.ndarray, load: int) -> np.ndarray:
    return np.maximum(SKETCH_LEAST, 1 << np.ceil(np.log2(np.maximum(size, 1) / load)).clip(0).astype(np.int64))


def sketches(h: np.ndarray, edge: np.ndarray, load: int) -> list[np.ndarray]:
    """Each document's parity words: as many as its size calls for."""
    size = np.diff(edge)
    words = sketch_words(size, load)
    base = np.cumsum(words) - words
    owner = np.repeat(np.arange(len(size)), size)
    bit = ((mix(h, 91) >> U(8)) & (words[owner] * 64 - 1).astype(np.uint64)).astype(np.int64)
    out = np.zeros(int(words.sum()), np.uint64)
    np.bitwise_xor.at(out, base[owner] + (bit >> 6), U(1) << (bit & 63).astype(np.uint64))
    return [out[b : b + w] for b, w in zip(base.tolist(), words.tolist(), strict=True)]


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """The sketch as it would be with fewer words."""
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def most_apart(a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """The most shingles that linked sets of these sizes differ in."""
    return (a + b) * (den - num) // (den + num)


def document_sets(texts: DataFrame, k: int) -> DataFrame:
    """(doc_id, d, tag, tag2, n, node, sketch, fine): one row per row of `texts`; node is null for the empty set."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, buf, off in chunks(batch.column(4)):
                h, edge = doc_sets(buf, off, k)
                node, fine = nodes_of(h, edge), sketches(h, edge, FINE_LOAD)
                sketch = [folded(x, w) for x, w in zip(fine, sketch_words(np.diff(edge), SKETCH_LOAD).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i)[a:b] for i in range(4)),
                        pa.array(np.diff(edge).astype(np.int64)),
                        pa.array(node.view(np.int64), mask=node == 0),
                        *(pa.array([x.tobytes() for x in words], pa.binary()) for words in (sketch, fine)),
                    ],
                    ["doc_id", *DOC, "n", "node", "sketch", "fine"],
                )

    return texts.select("doc_id", *DOC, "text").mapInArrow(work, "doc_id long, d long, tag long, tag2 long, n long, node long, sketch binary, fine binary")


def live_signatures(texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(sig, node, many): groups of nodes that share a signature, with the number of rows in each.

    Signatures travel packed: a row per chunk of documents and partition, four
    bytes each; those that agree by chance only hold more nodes than they had to.
    Signatures with the same nodes, such as those of a pair of copies, make one
    group, named by a hash of what it holds; if names collide, a group only
    holds more nodes than it had to.
    """

    # numbers that Spark's hash deals to different partitions
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = texts.sparkSession.range(16 * parts).select(F.col("id").cast("int").alias("id"))
    dealt = numbers.groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("part")).agg(F.min("id").alias("id"))
    bucket = np.sort(dealt.toArrow()["id"].to_numpy())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in chunks(batch.column(0)):
                h, edge = doc_sets(buf, off, k)
                node = nodes_of(h, edge)
                _, one = np.unique(node, return_index=True)  # equal sets of a chunk speak once
                one.sort()
                at = np.concatenate([np.arange(edge[i], edge[i + 1]) for i in one]) if len(one) else np.zeros(0, np.int64)
                size = np.diff(edge)[one]
                sig, doc = signatures(h[at], np.concatenate([[0], np.cumsum(size)]), num, den)
                # a row per bucket: 32 bits of each signature beside the bucket's own, and its node
                to = (sig % U(len(bucket))).astype(np.int64)
                order = np.lexsort((doc, to))
                start = np.searchsorted(to[order], np.arange(len(bucket) + 1))
                full = np.flatnonzero(np.diff(start))
                offsets = pa.array(np.append(start[full], len(order)).astype(np.int32))
                codes = pa.array((sig[order] >> U(32)).astype(np.uint32).view(np.int32))
                nodes = pa.array(node[one][doc[order]].view(np.int64))
                lists = [pa.ListArray.from_arrays(offsets, c) for c in (codes, nodes)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[full].astype(np.int32)), *lists], ["bucket", "code", "node"])

    packed = texts.select("text").mapInArrow(work, "bucket int, code array<int>, node array<long>").repartition("bucket")
    rows = packed.select("bucket", F.inline(F.arrays_zip("code", "node")))
    by_sig = Window.partitionBy("bucket", "code")
    name = F.xxhash64(F.min("node").over(by_sig), F.max("node").over(by_sig), F.expr("bit_xor(xxhash64(node))").over(by_sig), F.count(F.lit(1)).over(by_sig))
    seen = rows.select(
        "node", name.alias("sig"), F.count(F.lit(1)).over(by_sig).alias("many"),
        (F.min("node").over(by_sig) < F.max("node").over(by_sig)).alias("several"),
    )
    return seen.filter("several").select("sig", "node", "many").distinct()


def lists_before(column: pa.ChunkedArray, sig: np.ndarray) -> np.ndarray:
    """The rows' lists of signatures, filled up with their own one."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = np.repeat(sig[:, None], BEFORE, axis=1)
    out[np.arange(BEFORE) < size[:, None]] = lists.flatten().to_numpy()
    return out


def left_before(before: np.ndarray, sig: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) of rows under one signature also meet under another listed for both."""
    out = np.zeros(len(x), bool)
    step = CELLS // BEFORE**2
    for s in range(0, len(x), step):
        at = x[s : s + step]
        a, b = before[at], before[y[s : s + step]]
        out[s : s + step] = ((a[:, :, None] == b[:, None, :]) & (a != sig[at, None])[:, :, None]).any(axis=(1, 2))
    return out


def tile_pairs(num: int, den: int, give: str):
    """A function over batches of (sig, i, j, blk, node, comp, n, many, sketch, before) in (sig, i, j) order.

    Gives (a, b, apart) pairs of nodes in different components that may link: all of them ("every"), or for each
    node only the one that its sketch says is nearest ("nearest"); or ("rows") the rows (sig, node, comp, many) that
    have such a partner.  Pairs that also meet under a signature of `before`, which all precede `sig`, are left to it:
    nothing is lost, as no pair is left at the first signature that its nodes share, and there a node's nearest is as near.
    """
    every, marks = give == "every", give == "rows"

    def tile(sig, node, comp, n, blk, raw, before, i, j):
        order = np.argsort(n, kind="stable")
        met = np.zeros(len(n), bool)
        node, comp, n, blk = node[order], comp[order], n[order], blk[order]
        before = before[order] if before is not None else None
        raw = [raw[x] for x in order]
        best_apart = np.full(len(node), 1 << 60)
        best = np.full(len(node), -1)
        out = []

        def compare(left, right, words):
            x, y = (np.stack([folded(raw[r], words) for r in side]) for side in (left, right))
            step = max(1, CELLS // max(1, len(right) * words))
            for s in range(0, len(left), step):
                rows = left[s : s + step]
                # sizes ascend: partners outside the ratio are not looked at
                lo = np.searchsorted(n[right], n[rows[0]] * num // den, "left")
                hi = np.searchsorted(n[right], -(-n[rows[-1]] * den // num), "right")
                cols = right[lo:hi]
                if len(cols) == 0:
                    continue
                apart = np.bitwise_count(x[s : s + step, None, :] ^ y[None, lo:hi, :]).sum(axis=2, dtype=np.int64)
                most = most_apart(n[rows, None], n[None, cols], num, den)
                apart = np.maximum(apart, np.abs(n[rows, None] - n[None, cols]))
                fit = (apart <= most) & (comp[rows, None] != comp[None, cols])
                if marks:
                    met[order[rows[fit.any(axis=1)]]] = True
                    met[order[cols[fit.any(axis=0)]]] = True
                elif every:
                    r, c = np.nonzero(fit & (node[rows, None] < node[None, cols]) if i == j else fit)
                    new = ~left_before(before, sig, rows[r], cols[c])
                    r, c = r[new], c[new]
                    out.append((node[rows[r]], node[cols[c]], apart[r, c]))
                else:
                    apart[~fit] = 1 << 60
                    for axis, own, other in ((1, rows, cols), (0, cols, rows)):
                        at = apart.argmin(axis=axis)
                        value = apart.min(axis=axis)
                        nearer = value < best_apart[own]
                        best_apart[own[nearer]] = value[nearer]
                        best[own[nearer]] = other[at[nearer]]

        # as wide as both sketches allow, so that a pair is as far apart under every signature
        words = np.array([len(x) for x in raw])
        sides = [[at[words[at] == w] for w in np.unique(words[at])] for at in (np.flatnonzero(blk == i), np.flatnonzero(blk == j))]
        for left in sides[0]:
            for right in sides[1]:
                compare(left, right, min(words[left[0]], words[right[0]]))
        if marks:
            return met
        if not every:
            at = np.flatnonzero(best >= 0)
            at = at[~left_before(before, sig, at, best[at])]
            out.append((node[at], node[best[at]], best_apart[at]))
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def pairs_of(table: pa.Table) -> Iterator[pa.RecordBatch]:
            cols = [table[c].to_numpy() for c in ("sig", "i", "j", "blk", "node", "comp", "n")]
            raw = [np.frombuffer(x.as_buffer(), np.uint64) for chunk in table["sketch"].chunks for x in chunk]
            new = np.ones(len(raw), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(raw)))
            sig, i, j, blk, node, comp, n = cols
            before = None if marks else lists_before(table["before"], sig)
            out = []
            # tiles of two rows, most of all
            two = start[size == 2]
            two = two[(comp[two] != comp[two + 1]) & (i[two] == j[two])]
            apart = np.abs(n[two] - n[two + 1])
            for at, first in enumerate(two.tolist()):
                x, y = raw[first], raw[first + 1]
                least = min(len(x), len(y))
                apart[at] = max(apart[at], int(np.bitwise_count(folded(x, least) ^ folded(y, least)).sum()))
            fit = apart <= most_apart(n[two], n[two + 1], num, den)
            met = np.zeros(len(raw), bool)
            met[two[fit]] = met[two[fit] + 1] = True
            if not marks:
                fit[fit] = ~left_before(before, sig, two[fit], two[fit] + 1)
            out.append((node[two[fit]], node[two[fit] + 1], apart[fit]))
            if not every:  # each of the two looks for its nearest
                out.append((node[two[fit] + 1], node[two[fit]], apart[fit]))
            for s, m in zip(start.tolist(), size.tolist(), strict=True):
                if m > 2 or (m == 2 and i[s] != j[s]):
                    e = s + m
                    found = tile(sig[s:e], node[s:e], comp[s:e], n[s:e], blk[s:e], raw[s:e], None if marks else before[s:e], i[s], j[s])
                    if marks:
                        met[s:e] |= found
                    else:
                        out += found
            if marks:
                yield pa.RecordBatch.from_arrays([pa.array(table[c].to_numpy()[met]) for c in ("sig", "node", "comp", "many")], ["sig", "node", "comp", "many"])
                return
            a, b, apart = (np.concatenate([x[c] for x in out]) for c in range(3))
            one = np.lexsort((b, apart, a)) if not every else np.lexsort((b, a))
            keep = np.ones(len(one), bool)
            keep[1:] = a[one][1:] != a[one][:-1]
            if every:
                keep[1:] |= b[one][1:] != b[one][:-1]
            one = one[keep]
            yield pa.RecordBatch.from_arrays([pa.array(x[one]) for x in (a, b, apart)], ["a", "b", "apart"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table])
            key = [table[c].to_numpy() for c in ("sig", "i", "j")]
            last = np.flatnonzero(np.any([c != c[-1] for c in key], axis=0)) if len(key[0]) else []
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from pairs_of(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and len(rest):
            yield from pairs_of(rest)

    return work


def candidate_pairs(rows: DataFrame, nodes: DataFrame, num: int, den: int, give: str, sketch: str = "sketch") -> DataFrame:
    """What `tile_pairs` gives, from distinct rows (sig, node, many, comp) and nodes (node, n, and the sketch to compare)."""
    lists = []
    if give != "rows":
        next_before = Window.partitionBy("node").orderBy("sig").rowsBetween(-BEFORE, -1)
        rows, lists = rows.withColumn("before", F.collect_list("sig").over(next_before)), ["before"]
    rows = rows.join(nodes.select("node", "n", F.col(sketch).alias("sketch")), "node")
    blocks = F.ceil(F.col("many") / TILE).cast("int")
    dealt = rows.withColumn("blk", F.pmod(F.xxhash64("node", "sig"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select("sig", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "node", "comp", "n", "many", "sketch", *lists)
    tiles = dealt.repartition("sig", "i", "j").sortWithinPartitions("sig", "i", "j")
    schema = "sig long, node long, comp long, many long" if give == "rows" else "a long, b long, apart long"
    return tiles.mapInArrow(tile_pairs(num, den, give), schema)


def partners(rows: DataFrame, nodes: DataFrame, num: int, den: int, give: str) -> DataFrame:
    """`candidate_pairs` in two steps: small sketches tell which rows have a partner, fine ones are sent for those only.

    Near copies that lie somewhat beyond the threshold of each other pass the
    small sketches by the square of their number; fine sketches, four times as
    long, leave few pairs that don't link.
    """
    left = stash(candidate_pairs(rows, nodes, num, den, "rows").dropDuplicates(["sig", "node"]), "open")
    return candidate_pairs(left, nodes, num, den, give, "fine")


def every_pair(rows: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): all pairs across components that may link."""
    pairs = partners(rows, nodes, num, den, "every")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) of the pairs that link, from pairs (a, b) and sets (node, set)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = den * both >= num * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"])

    left = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def sets_of(texts: DataFrame, where: DataFrame, k: int) -> DataFrame:
    """(node, set): the hashed shingles of the documents (d, tag, tag2) that `where` names for its nodes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, off in chunks(batch.column(0)):
                h, edge = doc_sets(buf, off, k)
                node = nodes_of(h, edge)
                rows = [h[edge[i] : edge[i + 1]].tobytes() for i in range(len(node))]
                yield pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(rows, pa.binary())], ["node", "set"])

    where = F.broadcast(where) if where.count() <= KEYS_BROADCAST else where
    return texts.join(where, DOC).select("text").mapInArrow(work, "node long, set binary").dropDuplicates(["node"])


def nearest(rows: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): for each node its nearest possible partner in another component."""
    best = partners(rows, nodes, num, den, "nearest").groupBy("a").agg(F.min(F.struct("apart", "b")).alias("best"))
    return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def apart(live: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of the signatures whose nodes lie in several components, with their components."""
    by_sig = Window.partitionBy("sig")
    placed = live.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = placed.withColumn("x", F.min("comp").over(by_sig)).withColumn("y", F.max("comp").over(by_sig))
    return placed.filter("x <> y").drop("x", "y")


def merged(comp: DataFrame, links: DataFrame) -> DataFrame:
    """`comp` (node, comp) after links (a, b) between nodes; components are linked once however many links they have."""
    of_a = comp.select(F.col("node").alias("a"), F.col("comp").alias("x"))
    of_b = comp.select(F.col("node").alias("b"), F.col("comp").alias("y"))
    between = links.join(of_a, "a").join(of_b, "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).filter("a <> b").distinct()
    up = components(between).select(F.col("node").alias("below"), F.col("comp").alias("above"))
    return cut(comp.join(up, F.col("comp") == F.col("below"), "left").select("node", F.coalesce("above", "comp").alias("comp")))


def jaccard_join(
    docs: DataFrame,
    k: int = K,
    num: int = NUM,
    den: int = DEN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, tag, tag2, n_shingles, component_id, first): each row's near-duplicate class.

    Words are runs of `[^\\x20\\x09-\\x0D]` with A-Z in lower case; a document's
    set holds its distinct shingles of `k` words, or its whole sequence if that
    is shorter.  Documents link when den * intersection >= num * union.
    component_id is the smallest doc_id that links reach, itself included; `first`
    marks the rows of the document that comes first in its class by doc_id, null
    ids first, and then by `tag` and `tag2`, hashes of the text (a row listed
    twice is marked twice).  Null and empty texts and those without words have an
    empty set, link with nothing and are first themselves; where all ids of a
    class are null, so is component_id.  An empty table gives no rows; other
    columns are ignored.  Shingles are compared by 64-bit hashes.
    """
    if not 0 < num <= den:
        raise ValueError("0 < num <= den is needed")
    texts = ordered_texts(docs, id_col, text_col)
    own = stash(document_sets(texts, k), "sets")
    nodes = own.filter("node is not null").groupBy("node").agg(F.min(F.struct(*DOC)).alias("at"), F.min("n").alias("n"), F.min("sketch").alias("sketch"), F.min("fine").alias("fine"))
    nodes = stash(nodes, "nodes")
    live = stash(live_signatures(texts, k, num, den), "signatures")
    alone = live.withColumn("comp", F.col("node"))
    pairs = stash(nearest(alone, nodes, num, den), "near")
    wanted = stash(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = stash(sets_of(texts, cut(nodes.join(wanted, "node").select("at.*")), k), "shingles")
    comp, known = wanted.select("node", F.col("node").alias("comp")), None
    for step in range(ROUNDS + 1):
        if step:
            open_ = apart(live, comp)
            pairs = (nearest if step < ROUNDS else every_pair)(open_, nodes, num, den)
            pairs = stash(pairs.join(known, ["a", "b"], "left_anti"), "near")
            if pairs.isEmpty():
                continue
        known = pairs if known is None else known.unionByName(pairs)
        links = stash(verified(pairs, sets, num, den), "links")
        comp = comp if links.isEmpty() else merged(comp, links)
    classed = own.join(comp, "node", "left").withColumn("class", F.coalesce("comp", "node"))
    heads = classed.filter("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.min(F.struct(*DOC)).alias("head"))
    heads = cut(heads)  # read back, it does not tie the join to the aggregation's dealing: a class with very many rows can be split
    return classed.join(heads, "class", "left").select(
        "doc_id",
        "tag",
        "tag2",
        F.col("n").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"),
        (F.col("class").isNull() | (F.struct(*DOC) == F.col("head"))).alias("first"),
    )
