"""BPE against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from textlab.llm.bpe import Bpe, bpe_decode, bpe_encode, default_vocabulary

from .texts import corpus, frame, with_clashes


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_vocabulary())


@pytest.fixture(scope="module")
def bpe():
    with open(default_vocabulary(), encoding="utf-8") as f:
        return Bpe(f.read())


def cases():
    rnd = random.Random(4)
    yield from ("", " ", "\n\n x", "it's we'll I'D 'tis", "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "\x00\x7f\x85\xa0 　")
    for _ in range(400):
        yield "".join(rnd.choice("abcdefgh  \n\t'stre0123!?.éß²½√漢字🙂") for _ in range(rnd.randint(0, 60)))
        yield "".join(rnd.choice("aaabthe rn") for _ in range(200)).replace(" ", "e")
        yield "".join(chr(rnd.choice([rnd.randrange(32, 0x250), rnd.randrange(0x250, 0xD7FF), rnd.randrange(0xE000, 0x2FFFF)])) for _ in range(30))


def test_ids_and_round_trip(bpe, library):
    for text in cases():
        ids = bpe.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert bpe.decode_bytes(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)
        assert bpe.joined(ids).decode() == ",".join(map(str, ids.tolist()))


def test_partial_characters_decode_as_the_library_does(bpe, library):
    rnd = random.Random(5)
    for _ in range(300):
        ids = [rnd.randrange(50_257) for _ in range(rnd.randint(1, 12))]
        import numpy as np

        assert bpe.decode_bytes(np.array(ids, np.int32)).decode() == library.decode(ids, skip_special_tokens=False)


def test_long_pieces(bpe, library):
    rnd = random.Random(6)
    for text in ("a" * 50_000, "".join(rnd.choice("etaon") for _ in range(20_000)), " " * 20_000):
        assert bpe.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_columns(spark, library):
    rows = corpus(2, 60) + [(None, "null id"), (5, "listed twice"), (5, "listed twice")]
    out = bpe_encode(with_clashes(frame(spark, rows)), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    assert len(out) == len(rows)

    def want(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return (i, len(ids), ids, text or "", sha(",".join(map(str, ids))), sha(text or ""))

    assert sorted(map(repr, (tuple(r) for r in out))) == sorted(repr(want(*r)) for r in rows)


def test_decode_and_empty_table(spark):
    rows = corpus(3, 20)
    encoded = bpe_encode(frame(spark, rows))
    assert {r.doc_id: r.text for r in bpe_decode(encoded).collect()} == {i: t or "" for i, t in rows}
    assert bpe_encode(frame(spark, rows).filter("doc_id < -1")).count() == 0
