"""License scans by diagonal voting.

Every rolling word k-gram is hashed and joined to the template positions that
carry it; a hit at word p of a document and word t of a template votes for the
offset diagonal p - t.  A phrase stands where its diagonal has all its votes.
For the longer notices, votes are summed over neighbouring diagonals (words put
in or left out move a match by a few), and a notice is reported when the merged
span has enough of its k-grams.  Hits carry their words, which are compared with
the template's, so a collision of hashes cannot vote.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import chunks, keyed_texts, stash
from .words import ranges, split, word_hashes, prefix

# Phrases with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Opening or defining sentences of public license notices, with their labels.
NOTICES = [
    ("this work is licensed under the gnu general public license version 3", "gpl-3"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under the apache license version 2 0 you may not use this file except in compliance with the license", "apache-2.0"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "all-rights-reserved"),
]

#: Words to a k-gram.
GRAM = 2
#: Diagonals that differ by this much at most are neighbours.
NEAR = 3
#: Least share of a notice's k-grams that a merged span must have.
SHARE = 0.7

# Bytes that separate words once A-Z are lower case.
GAP = np.zeros(256, bool)
GAP[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def grams(buf: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(hash, first word, document, word starts, word ends) of every k consecutive words."""
    start, end, doc = split(buf, off, GAP)
    sums = prefix(word_hashes(buf, start, end))
    at = np.arange(max(0, len(start) - k + 1))
    at = at[doc[at] == doc[at + k - 1]]
    return ranges(sums, at, at + k), at, doc, start, end


def template_grams(templates: list[tuple[str, str]], k: int) -> list[tuple[int, str, int, int, int, str]]:
    """(template, label, grams of the template, position, hash, words) rows."""
    rows = []
    for i, (phrase, label) in enumerate(templates):
        words = phrase.split(" ")
        if len(words) < k:
            raise ValueError(f"a template needs {k} words at least: {phrase!r}")
        buf = np.frombuffer(" ".join(words).encode(), np.uint8)
        h = grams(buf, np.array([0, len(buf)]), k)[0].astype(np.int64)
        rows += [(i, label, len(h), t, int(x), " ".join(words[t : t + k])) for t, x in enumerate(h)]
    return rows


def license_scan(
    docs: DataFrame,
    phrases: list[tuple[str, str]] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
    id_col: str = "doc_id",
    text_col: str = "text",
    gram: int = GRAM,
    near: int = NEAR,
    share: float = SHARE,
) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score), one row per input row.

    n_base counts all places where a phrase's words stand consecutively,
    first_word and last_word are their smallest and largest start (null without
    one).  labels adds the notices found.  score is 1 with a phrase, else the
    largest share of a notice's k-grams in one merged span.  Labels are sorted
    and joined by commas; no label gives the empty string.  A null or empty
    text has no words; rows with a null or repeated doc_id are told apart by
    their text, and repeated rows get the same result each; an empty table gives
    no rows; other columns are ignored.  The templates are a parameter of a few
    kB, so they are broadcast; no text is shuffled.
    """
    spark = docs.sparkSession
    rows = template_grams(phrases + notices, gram)
    doc_key = ["doc_id", "tag", "tag2"]
    wanted = np.unique(np.array([r[4] for r in rows], np.int64))
    table = spark.createDataFrame(rows, "template int, label string, size int, t int, hash long, words string")

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("p", pa.int32()), ("hash", pa.int64()), ("words", pa.string())]))
        for batch in batches:
            for a, b, raw, off in chunks(batch.column(3)):
                buf = LOWER[raw]
                h, at, doc, start, end = grams(buf, off, gram)
                h = h.view(np.int64)
                count = np.bincount(doc, minlength=b - a)
                first = np.cumsum(count) - count
                at_hit = np.flatnonzero(np.isin(h, wanted))  # the join's keys; other k-grams have no partner
                found: list[list] = [[] for _ in range(b - a)]
                for i in at_hit:
                    w = at[i]
                    words = " ".join(buf[start[j] : end[j]].tobytes().decode() for j in range(w, w + gram))
                    found[doc[w]].append({"p": int(w - first[doc[w]]), "hash": int(h[i]), "words": words})
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i)[a:b] for i in range(3)), pa.array(count, pa.int64()), pa.array(found, kind)],
                    [*doc_key, "n_words", "hits"],
                )

    schema = "doc_id long, tag long, tag2 long, n_words long, hits array<struct<p:int,hash:long,words:string>>"
    read = stash(keyed_texts(docs, id_col, text_col).mapInArrow(hits, schema), "license")
    votes = (
        read.select(*doc_key, F.explode("hits").alias("hit"))
        .select(*doc_key, "hit.*")
        .join(F.broadcast(table), ["hash", "words"])
        .groupBy(*doc_key, "template", "label", "size", (F.col("p") - F.col("t")).alias("diagonal"))
        .agg(F.collect_set("t").alias("ts"))  # at most the template's length
    )
    exact = F.col("template") < len(phrases)
    base = (
        votes.filter(exact & (F.size("ts") == F.col("size")))
        .groupBy(*doc_key)
        .agg(
            F.count(F.lit(1)).alias("n_base"),
            F.min("diagonal").cast("long").alias("first_word"),
            F.max("diagonal").cast("long").alias("last_word"),
            F.collect_set("label").alias("base"),
        )
    )
    along = Window.partitionBy(*doc_key, "template").orderBy("diagonal")  # the votes of one document
    spans = (
        votes.filter(~exact)
        .withColumn("new", (F.col("diagonal") - F.lag("diagonal").over(along) > near).cast("int"))
        .withColumn("span", F.sum(F.coalesce("new", F.lit(0))).over(along))
        .groupBy(*doc_key, "template", "label", "size", "span")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_list("ts")))).alias("covered"))
        .withColumn("part", F.col("covered") / F.col("size"))
        .groupBy(*doc_key)
        .agg(F.max("part").alias("part"), F.collect_set(F.when(F.col("part") >= share, F.col("label"))).alias("found"))
    )
    none = F.array().cast("array<string>")
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    out = read.alias("d")
    for part, name in ((base, "b"), (spans, "s")):
        on = F.col("d.doc_id").eqNullSafe(F.col(f"{name}.doc_id"))
        for tag in ("tag", "tag2"):
            on &= F.col(f"d.{tag}") == F.col(f"{name}.{tag}")
        out = out.join(part.alias(name), on, "left")
    return out.select(
        F.col("d.doc_id"),
        F.col("d.n_words"),
        F.coalesce("b.n_base", F.lit(0)).alias("n_base"),
        F.col("b.first_word"),
        F.col("b.last_word"),
        joined(F.coalesce("b.base", none)).alias("base_labels"),
        joined(F.concat(F.coalesce("b.base", none), F.coalesce("s.found", none))).alias("labels"),
        F.when(F.col("b.n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("s.part", F.lit(0.0))).alias("score"),
    )
