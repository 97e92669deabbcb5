"""Decontamination against a plain search of phrases and stretches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textlab.llm.positional_index import build_index, decontaminate, phrase_matches, proximity_matches

from .texts import frame, with_clashes


def item_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def phrases(text, width):
    w = item_words(text)
    return [w[i : i + width] for i in range(max(1, len(w) - width + 1))] if w else []


def runs(hit):
    out = []
    for i, h in enumerate(hit):
        if h and (i == 0 or not hit[i - 1]):
            out.append([i, i + 1])
        elif h:
            out[-1][1] = i + 1
    return [tuple(x) for x in out]


def plain(docs, items, width=10):
    out = []
    for i, text in docs:
        w, named = item_words(text), set()
        hit = [False] * len(w)
        for name, item in items:
            for p in phrases(item, width):
                for a in range(len(w) - len(p) + 1):
                    if w[a : a + len(p)] == p:
                        hit[a : a + len(p)] = [True] * len(p)
                        named.add("" if name is None else str(name))
        # stretches that touch are one
        out.append((i, len(w), sum(hit), sorted(named), runs(hit), any(hit)))
    return out


def case(seed=1, n=60):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(40)] + ["é", "漢字", "the"]
    say = lambda k: " ".join(rnd.choice(voc) for _ in range(k))
    items = [(i, say(rnd.choice([1, 2, 9, 10, 11, 30]) if i % 3 else 25)) for i in range(20)]
    items += [(3, items[3][1]), (3, "another text of the same item w1 w2 w3 w4 w5"), (50, None), (51, ""), (52, ". , !"), (None, say(12)), (60, "the " * 14)]
    items = [(i, t) for i, t in items if len(item_words(t)) != 1]
    docs = []
    for i in range(n):
        text = say(rnd.choice([0, 1, 5, 30]))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            w = (rnd.choice(items)[1] or "").split()
            a = rnd.randint(0, max(0, len(w) - 12))
            text += rnd.choice([" ", "\n", "-, "]) + " ".join(w[a : a + rnd.choice([9, 10, 12, 40])]).upper() + " " + say(rnd.randint(0, 4))
        docs.append((i, text))
    docs += [(100, None), (101, ""), (None, "the " * 30), (None, items[0][1]), (5, items[1][1]), (5, items[1][1]), (102, say(900) + " " + items[0][1] + " " + say(700) + " the" * 40)]
    return docs, items


def tuples(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), [tuple(x) for x in r["spans"]], r["contaminated"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [(4 << 20, 4 << 20), (300, 200)])
def test_exact_phrases(spark, sizes):
    docs, items = case()
    tests = with_clashes(spark.createDataFrame(items, "item_id long, text string"))
    got = decontaminate(with_clashes(frame(spark, docs, 3)), tests, segment_bytes=sizes[0], slice_bytes=sizes[1])
    assert tuples(got) == sorted(plain(docs, items), key=repr)


def test_single_words_and_other_widths(spark):
    docs, items = case(seed=2)
    items = items[:8] + [(70, "the"), (71, "w5")]
    tests = spark.createDataFrame(items, "item_id long, text string")
    for width in (1, 3):
        assert tuples(decontaminate(frame(spark, docs, 2), tests, width=width, segment_bytes=400)) == sorted(plain(docs, items, width), key=repr)


def test_empty_tables(spark):
    docs, items = frame(spark, [(1, "a b c")], 1), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate(docs.filter("doc_id = 2"), items).count() == 0
    assert tuples(decontaminate(docs, items.filter("item_id = 2"))) == [(1, 3, 0, [], [], False)]
    assert tuples(decontaminate(docs, items)) == [(1, 3, 2, ["1"], [(0, 2)], True)]


def test_proximity(spark):
    docs = [
        (1, "x alpha one beta two gamma x"),  # two words between
        (2, "gamma beta alpha"),  # another order
        (3, "alpha beta and so on for a while then gamma"),  # too far
        (4, "alpha beta"),  # one is missing
        (5, "alpha alpha beta gamma x x x x x x x x gamma x beta x alpha"),  # two places
        (6, "x " * 500 + "gamma alpha x beta"),  # in a segment of its own
    ]
    items = spark.createDataFrame([(9, "Alpha, beta gamma!")], "item_id long, text string")
    index = build_index(frame(spark, docs, 2), segment_bytes=200)
    near = proximity_matches(index, items, slack=2).join(index.rows, "row")
    got = sorted((r["doc_id"], r["start"], r["end"]) for r in near.collect())
    assert got == [(1, 1, 6), (2, 0, 3), (5, 1, 4), (5, 12, 17), (6, 500, 504)]
    exact = phrase_matches(index, items).join(index.rows, "row").select("doc_id", "item_id", "start", "end")
    assert [tuple(r) for r in exact.collect()] == [(5, "9", 1, 4)]
    with pytest.raises(ValueError):
        phrase_matches(index, items, width=65)


def test_the_index_holds_every_word_once(spark):
    docs, _ = case(seed=3)
    for size in (4 << 20, 250):
        index = build_index(frame(spark, docs, 2), segment_bytes=size)
        counted = index.rows.agg(F.sum("n_words")).first()[0]
        assert counted == sum(len(item_words(t)) for _, t in docs)
        starts = index.postings.filter("term = ''").agg(F.sum(F.size("positions"))).first()[0]
        if size > 250:
            held = index.postings.filter("term <> ''").agg(F.sum(F.size("positions"))).first()[0]
            assert held == counted and starts == len(docs)
