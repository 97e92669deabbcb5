"""Substring, suffix-array and Jaccard dedup against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlab.llm import jaccard_join as jj
from textlab.llm import recompress, repeats, suffix_family

from .texts import corpus, frame, linked_components, repeated_windows, shingle_set, with_clashes, words


def expected_words(rows, width):
    seqs = {i: [w.encode() for w in words(t)] for i, t in rows}
    gone = repeated_windows(seqs, width)
    return {i: (len(s), sum(gone[i]), b" ".join(w for w, g in zip(s, gone[i]) if not g).decode()) for i, s in seqs.items()}


def expected_bytes(rows, width):
    raw = {i: (t or "").encode() for i, t in rows}
    gone = repeated_windows({i: list(v) for i, v in raw.items()}, width)
    out = {}
    for i, v in raw.items():
        g = gone[i]
        runs = sum(1 for j in range(len(g)) if g[j] and (j == 0 or not g[j - 1]))
        out[i] = (len(v), sum(g), runs, bytes(b for b, x in zip(v, g) if not x))
    return out


@pytest.mark.parametrize(("gather", "seed"), [(400_000, 1), (50, 2)])
def test_substring_dedup(spark, monkeypatch, gather, seed):
    monkeypatch.setattr(repeats, "GATHER", gather)
    rows = corpus(seed)
    got = recompress.substring_dedup(with_clashes(frame(spark, rows))).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == expected_words(rows, 20)
    assert len(got) == len(rows)


def test_substring_dedup_other_width(spark):
    rows = corpus(3, 80)
    got = recompress.substring_dedup(frame(spark, rows), width=7, rounds=1).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == expected_words(rows, 7)


@pytest.mark.parametrize(("gather", "batch", "seed"), [(400_000, 1 << 16, 1), (50, 37, 2)])
def test_suffix_dedup(spark, monkeypatch, gather, batch, seed):
    monkeypatch.setattr(repeats, "GATHER", gather)
    plain = suffix_family.by_family
    monkeypatch.setattr(suffix_family, "by_family", lambda rows: plain(rows, batch))
    rows = corpus(seed)
    got = suffix_family.suffix_dedup(with_clashes(frame(spark, rows))).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == expected_bytes(rows, 100)


def test_dedup_null_and_repeated_ids(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(None, text), (None, text), (3, text), (3, text), (3, "other"), (None, None), (4, "")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in recompress.substring_dedup(frame(spark, rows, 2)).collect())
    # the null id comes first; a row listed twice is no repeat of itself
    assert got == [(False, 3, 1, 0), (False, 3, 40, 40), (False, 3, 40, 40), (False, 4, 0, 0), (True, 0, 0, 0), (True, 0, 40, 0), (True, 0, 40, 0)]
    got = sorted((r.doc_id is None, r.n_removed, r.n_spans) for r in suffix_family.suffix_dedup(frame(spark, rows, 2)).collect())
    assert got == [(False, 0, 0), (False, 0, 0), (False, len(text), 1), (False, len(text), 1), (True, 0, 0), (True, 0, 0), (True, 0, 0)]


def test_dedup_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert recompress.substring_dedup(none).count() == 0
    assert suffix_family.suffix_dedup(none).count() == 0
    assert jj.jaccard_join(none).count() == 0


@pytest.mark.parametrize(("k", "num", "tile", "seed"), [(4, 85, 2048, 5), (5, 80, 3, 6)])
def test_jaccard_join(spark, monkeypatch, k, num, tile, seed):
    monkeypatch.setattr(jj, "TILE", tile)
    rows = corpus(seed, 300)
    sets = {i: shingle_set(t, k) for i, t in rows}
    least = linked_components(sets, num, 100)
    got = jj.jaccard_join(with_clashes(frame(spark, rows)), k=k, num=num).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(sets[i]), least[i]) for i in sets}
    assert {r.doc_id for r in got if r.first} == {i for i in sets if least[i] == i}


def test_jaccard_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e f"), (7, "A B c d e f"), (7, "a b c d e f"), (9, None), (None, " "), (8, "x")]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.first) for r in jj.jaccard_join(frame(spark, rows, 2)).collect())
    assert got == [(-1, 0, -1, True), (-1, 3, 7, True), (7, 3, 7, False), (7, 3, 7, False), (8, 1, 8, True), (9, 0, 9, True)]


def test_every_scheme_has_enough_agreeing_segments():
    for num in (50, 80, 85, 95):
        lows = jj.bands(num, 100, 3000)
        for low, high in zip(lows[:-1].tolist(), lows[1:].tolist()):
            m, p, x = jj.scheme(num, 100, low, high)
            most = max((a + b) * (100 - num) // (100 + num) for a in (low, high - 1) for b in (a, a * 100 // num))
            assert (m + p if p else m - x) > most


def test_texts_with_the_same_31_bits_of_hash_stay_apart(spark):
    passage = " ".join(f"t{i}" for i in range(40))
    rows = [(None, f"x177913 {passage}"), (None, f"x230585 {passage}"), (None, f"x230585 {passage}")]
    df = frame(spark, rows, 2)
    low = df.select(F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1)).alias("h")).distinct().count()
    assert low == 1
    got = [r.n_removed for r in recompress.substring_dedup(df).collect()]
    assert sorted(got) in ([0, 0, 40], [0, 40, 40])  # whichever text comes first
    got = [r.n_removed for r in suffix_family.suffix_dedup(df).collect()]
    assert sorted(got) in ([0, 0, len(passage) + 1], [0, len(passage) + 1, len(passage) + 1])
    got = jj.jaccard_join(df).collect()
    assert len({(r.tag, r.tag2) for r in got}) == 2 and len({(r.tag, r.tag2) for r in got if r.first}) == 1


def tile_input(spark, shared):
    """Rows and nodes for `partners`: sets of 100 shingles whose sketches rule nothing out."""
    rows = [(sig, node, len(nodes), node) for sig, nodes in shared.items() for node in nodes]
    rows = spark.createDataFrame(rows, "sig long, node long, many long, comp long")
    nodes = spark.createDataFrame([(i, 100, bytes(32), bytes(32)) for i in {n for v in shared.values() for n in v}], "node long, n long, sketch binary, fine binary")
    return rows, nodes


def test_near_copies_give_a_pair_once_however_many_signatures_they_share(spark):
    shared = {7919 * s: list(range(1, 13)) for s in range(1, 41)} | {-s: [100, 101] for s in range(1, 41)}
    rows, nodes = tile_input(spark, shared)
    got = [(r.a, r.b) for r in jj.partners(rows, nodes, 80, 100, "every").collect()]
    assert sorted(tuple(sorted(p)) for p in got) == [(a, b) for a in range(1, 13) for b in range(a + 1, 13)] + [(100, 101)]
    near = [r.a for r in jj.partners(rows, nodes, 80, 100, "nearest").collect()]
    assert sorted(near) == [*range(1, 13), 100, 101]


@pytest.mark.parametrize("tile", [2048, 3])
def test_no_pair_is_lost_between_signatures(spark, monkeypatch, tile):
    monkeypatch.setattr(jj, "TILE", tile)
    monkeypatch.setattr(jj, "BEFORE", 4)
    rng = random.Random(8)
    shared = {rng.getrandbits(62): sorted(rng.sample(range(1, 60), rng.choice([2, 2, 3, 9]))) for _ in range(200)}
    rows, nodes = tile_input(spark, shared)
    got = [tuple(sorted((r.a, r.b))) for r in jj.partners(rows, nodes, 80, 100, "every").collect()]
    assert set(got) == {(a, b) for v in shared.values() for a in v for b in v if a < b}
    near = {r.a for r in jj.partners(rows, nodes, 80, 100, "nearest").collect()}
    assert near == {n for v in shared.values() for n in v}


def test_a_pair_ruled_out_elsewhere_hides_no_link(spark):
    """Wide sketches rule out (1, 2), which a narrow sketch in the same group must not put before (1, 3)."""
    wide = lambda bits: np.array([(1 << bits) - 1, 0, 0, 0, (1 << bits) - 1, 0, 0, 0], np.uint64).tobytes()
    sizes = {1: (110, wide(0)), 2: (110, wide(30)), 3: (109, bytes(64)), 4: (100, bytes(32))}
    nodes = spark.createDataFrame([(i, n, s, s) for i, (n, s) in sizes.items()], "node long, n long, sketch binary, fine binary")
    shared = {10: [1, 2], 20: [1, 2, 3, 4]}
    # 3 and 4 are one component, as are 2 and 4
    rows = spark.createDataFrame([(sig, i, len(v), 1 if i == 1 else 3) for sig, v in shared.items() for i in v], "sig long, node long, many long, comp long")
    got = {(r.a, r.b) for r in jj.candidate_pairs(rows, nodes, 80, 100, "nearest").collect()}
    assert (1, 3) in got and (1, 2) not in got
