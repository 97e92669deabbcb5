"""Small documents with nulls, empty and long texts, copies, ties and repeated rows, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F


def words(text, lower=False):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def corpus(seed=1, n=150):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(300)] + ["é", "漢字", "it's"]
    passages = [" ".join(rnd.choice(voc) for _ in range(m)) for m in (25, 30, 40, 60)] + ["run " * 40, "ab cd " * 30]
    rows = []
    for i in range(n):
        text = " ".join(rnd.choice(voc) for _ in range(rnd.choice([0, 1, 3, 8, 20, 40, 80])))
        if rnd.random() < 0.4:
            text += rnd.choice([" ", "\n", "\t"]) + rnd.choice(passages) + " " + " ".join(rnd.choice(voc) for _ in range(rnd.randint(0, 20)))
        if rows and rnd.random() < 0.15:
            text = rnd.choice(rows)[1] or ""
        if rows and rnd.random() < 0.3:
            w = (rnd.choice(rows)[1] or "q").split()
            for _ in range(rnd.randint(1, 3)):
                if w:
                    w[rnd.randrange(len(w))] = "CHANGED"
            text = " ".join(w)
        if i % 37 == 0:
            text = None
        rows.append((i, text))
    rows.append((n, "long " * 3000 + "end"))
    rnd.shuffle(rows)
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)


def with_clashes(df):
    """Columns with names that operators use inside."""
    for name in ("tag", "d", "key", "n", "node", "sig", "spans", "ctx", "copy", "score", "rank", "q", "vec", "id"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit("x"))
    return df


def repeated_windows(sequences, width):
    """{id: [removed?]}: units in a window that also starts earlier."""
    seen, out = set(), {}
    for i in sorted(sequences):
        s = sequences[i]
        gone = [False] * len(s)
        for a in range(len(s) - width + 1):
            w = tuple(s[a : a + width])
            if w in seen:
                gone[a : a + width] = [True] * width
            seen.add(w)
        out[i] = gone
    return out


def shingle_set(text, k):
    w = words(text, lower=True)
    if not w:
        return set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def linked_components(sets, num, den):
    """{id: smallest id reachable}, links where den * intersection >= num * union."""
    of = {i: i for i in sets}

    def root(x):
        while of[x] != x:
            x = of[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = root(a), root(b)
                    of[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}
