"""License scans against a plain search."""

import random
import re

from pyspark.sql import functions as F

from textlab.llm.license_scan import NOTICES, PHRASES, license_scan

from .texts import frame, with_clashes


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def texts():
    rnd = random.Random(8)
    parts = [p for p, _ in PHRASES] + [n for n, _ in NOTICES] + ["GNU General  Public-License", "CC BY-NC", "cc, by", "the", "é license", "gnu general", "mit"]
    rows = [(i, " ".join(rnd.choice(parts) if rnd.random() < 0.3 else rnd.choice(["of", "the", "license", "x1", "cc", "apache"]) for _ in range(rnd.randint(0, 30)))) for i in range(200)]
    return rows + [(200, None), (201, ""), (202, "cc by " * 3000), (None, "MIT License"), (None, "nothing"), (5, "Apache license"), (5, "Apache license")]


def test_base_columns(spark):
    rows = texts()
    got = license_scan(with_clashes(frame(spark, rows))).collect()
    mine = sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got)
    assert mine == sorted(repr((i, *plain(t))) for i, t in rows)
    for r in got:
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)
        base, every = set(filter(None, r.base_labels.split(","))), r.labels.split(",") if r.labels else []
        assert base <= set(every) and every == sorted(set(every))


def test_notices_with_changed_words(spark):
    mit = next(n for n, label in NOTICES if label == "mit" and "granted" in n)
    w = mit.split()
    changed = " ".join(w[:9] + ["most", "kindly"] + w[9:20] + w[21:])
    rows = [(0, "x y " + mit), (1, "some text " + changed + " more"), (2, " ".join(w[:6])), (3, " ".join(reversed(w))), (4, "All rights reserved.")]
    got = {r.doc_id: r for r in license_scan(frame(spark, rows)).collect()}
    assert got[0].labels == got[1].labels == "mit" and got[1].n_base == 0 and 0.7 <= got[1].score < 1
    assert got[2].labels == got[3].labels == ""
    assert got[4].labels == "all-rights-reserved"


def test_nothing(spark):
    assert license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_with_the_same_31_bits_of_hash_stay_apart(spark):
    df = frame(spark, [(None, "MIT license 90246"), (None, "Apache License 231457")], 2)
    assert df.select(F.xxhash64("text").bitwiseAND(F.lit((1 << 31) - 1))).distinct().count() == 1
    assert sorted((r.n_base, r.labels) for r in license_scan(df).collect()) == [(1, "apache"), (1, "mit")]
