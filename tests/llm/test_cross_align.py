"""Alignment against a plain version with the tokenizers' own libraries."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from textlab.llm import cross_align as C
from textlab.llm.bpe import byte_chars

from .texts import corpus, frame, with_clashes

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
BACK = {c: b for b, c in enumerate(byte_chars())}


def spelled(text):
    """(ids, ends) of both sides, or None."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(BACK[c] for c in A.id_to_token(x)) for x in a]
    b_bytes = [bytes([int(B.id_to_piece(x)[1:-1], 16)]) if B.is_byte(x) else B.id_to_piece(x).replace("▁", " ").encode() for x in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return None
    return a, b, np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()


def plain(rows):
    out, linked = [], []
    for i, text in rows:
        found = spelled(text) if text else None
        if not found:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            linked.append([])
            continue
        a, b, ends_a, ends_b = found
        ends = sorted({*ends_a, *ends_b})
        linked.append([(a[x], b[y]) for x, y in zip(np.searchsorted(ends_a, ends).tolist(), np.searchsorted(ends_b, ends).tolist())])
        groups, x, y = [], 0, 0
        for cut in sorted({*ends_a} & {*ends_b}):
            u, v = ends_a.index(cut, x) + 1, ends_b.index(cut, y) + 1
            groups.append(",".join(map(str, a[x:u])) + "|" + ",".join(map(str, b[y:v])))
            x, y = u, v
        out.append((i, len(a), len(b), len(groups), len(ends), 0, 0, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    held = collections.Counter(p for pairs in linked for p in set(pairs))
    top: dict = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return [(*o[:5], sum(held[p] == top[p[0]] for p in pairs), sum(held[p] for p in pairs), o[7]) for o, pairs in zip(out, linked)]


def odd_rows():
    rnd = random.Random(5)
    wild = "ab é漢😀 \n\t 　'12.,<|>s▁́"
    rows = [(1000 + i, "".join(rnd.choice(wild) for _ in range(rnd.randint(1, 60)))) for i in range(60)]
    return rows + [
        (1, None), (2, ""), (3, " "), (4, "  a  b  "), (5, "x▁y"), (6, "<|endoftext|> <s> </s> <unk> 漢字😀"), (7, "q" * 3000),
        (8, "long " * 4000 + " " * 300 + "z"), (9, "12 345 6789, " * 500), (None, "null id"), (10, "twice"), (10, "twice"), (10, "other text"),
    ]


@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 18, 4 << 20), (500, 120, 1500)])
def test_against_the_libraries(spark, monkeypatch, sizes):
    for name, value in zip(("STEP_CHARS", "PART_CHARS", "CHUNK_CHARS"), sizes, strict=True):
        monkeypatch.setattr(C, name, value)
    rows = corpus(seed=7, n=120) + odd_rows()
    got = [tuple(r) for r in C.cross_align(with_clashes(frame(spark, rows, 3))).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


def test_groups_as_text(spark):
    text = "Divide and conquer at shared cuts."
    row = C.cross_align(frame(spark, [(1, text)], 1), groups=True).first()
    a, b = zip(*(g.split("|") for g in row["groups"].split(";")))
    want_a, want_b, ends_a, ends_b = spelled(text)
    assert [int(x) for g in a for x in g.split(",")] == want_a and [int(x) for g in b for x in g.split(",")] == want_b
    assert row["n_groups"] == len({*ends_a} & {*ends_b})
    assert hashlib.sha256(row["groups"].encode()).hexdigest() == row["groups_sha256"]


def test_empty_table(spark):
    assert C.cross_align(frame(spark, [(1, "a")], 1).filter("doc_id = 2")).count() == 0
    assert [tuple(r)[1:] for r in C.cross_align(frame(spark, [(1, None), (2, "")], 2)).collect()] == [(0,) * 6 + ("",)] * 2


def test_shared_cuts_of_random_ends():
    rnd = np.random.default_rng(0)
    for chance in (0.5, 0.05, 0.002):
        n = 3000
        a, b = (np.append(np.flatnonzero(rnd.random(n) < p), n) for p in (chance, 0.3))
        got_a, got_b = C.shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
        both = np.intersect1d(a, b)
        assert a[got_a].tolist() == b[got_b].tolist() == both.tolist()


def test_no_shared_cut_takes_few_steps():
    a, b = np.append(np.arange(1, 400_000, 2), 400_000), np.append(np.arange(2, 400_000, 2), 400_000)
    cut_a, cut_b = C.shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
    assert (len(cut_a), len(cut_b)) == (1, 1)
