"""The registered queries of the training-data operators, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .common import read_table
from .cross_align import cross_align
from .exact_topk import exact_topk
from .jaccard_join import jaccard_join
from .license_scan import license_scan
from .mixing import poisson_mix
from .pii import KINDS, find_pii
from .positional_index import decontaminate
from .prefix_forest import prefix_forest
from .quality import quality_scores
from .recompress import substring_dedup
from .suffix_family import suffix_dedup
from .whitening import whiten


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(read_table(spark, sf_dir, "documents"), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest(read_table(spark, sf_dir, "embeddings"), k=20)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(read_table(spark, sf_dir, "embeddings"), k=10)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source to the same share of the characters, as many characters as there are; every row draws for itself."""
    return poisson_mix(read_table(spark, sf_dir, "documents"), by_row=True).select("doc_id", "source", "copy", "shuffle_key")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(read_table(spark, sf_dir, "documents"))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    def joined(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *(number(k) for k in KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_align(read_table(spark, sf_dir, "documents"))


def op13_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe, op2_prefix_forest, op3_license_scan, op4_exact_topk, op5_jaccard_join, op6_suffix_dedup, op7_recompression,
        op8_quality, op9_poisson_mix, op10_pii, op11_whitening, op12_cross_align, op13_positional_index,
    )
}

SQL: dict[str, str] = {
    "op4_exact_topk": """
        WITH v AS (
          SELECT row_number() OVER () AS r, * FROM (
            SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e, embedding
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
        s AS (
          SELECT q.r, q.vec_id AS query_id, c.vec_id AS vec_id,
                 list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, n::INT AS rank, vec_id, score FROM r WHERE n <= 10
    """,
    # one draw a document: at the rates of the driver's tables, far under 256
    "op9_poisson_mix": """
        WITH m AS (SELECT source, sum(length(coalesce(text, '')) + 1) AS mass FROM documents GROUP BY source),
        r AS (SELECT source, (SELECT sum(mass) FROM m)::DOUBLE * (1.0::DOUBLE / (SELECT count(*) FROM m)::DOUBLE) / mass::DOUBLE AS rate FROM m),
        k AS (SELECT source, rate, unnest(range(0, 400)) AS k FROM r),
        t AS (SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS p FROM k),
        c AS (SELECT source, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS cdf FROM t),
        h AS (SELECT doc_id, source, CASE WHEN doc_id IS NULL OR count(*) OVER (PARTITION BY doc_id) > 1 THEN md5(concat_ws(chr(31),
                coalesce(doc_id::VARCHAR, chr(30)), coalesce(text, chr(30)), coalesce(lang, chr(30)), coalesce(source, chr(30)),
                coalesce(n_chars::VARCHAR, chr(30)))) END AS content FROM documents),
        g AS (SELECT doc_id, source, concat_ws(':', coalesce(doc_id::VARCHAR, 'null'), content,
                CASE WHEN content IS NOT NULL THEN row_number() OVER (PARTITION BY content)::VARCHAR END) AS key FROM h),
        u AS (SELECT *, ('0x' || substr(md5('mix-1:' || key || ':1'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM g),
        n AS (SELECT u.doc_id, u.source, u.key, count(*) FILTER (WHERE c.cdf <= u.u) AS copies
              FROM u JOIN c ON u.source IS NOT DISTINCT FROM c.source GROUP BY u.doc_id, u.source, u.key),
        e AS (SELECT doc_id, source, key, unnest(range(1, copies + 1))::INT AS copy FROM n)
        SELECT doc_id, source, copy, md5('mix-1:' || key || ':copy:' || copy) AS shuffle_key FROM e
    """,
    # an item's words in a row, and every document's words in rows of the same lengths
    "op13_positional_index": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT DISTINCT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        p AS (SELECT item, least(len(w), 10) AS n, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
        q AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM p),
        l AS (SELECT DISTINCT n FROM q),
        x AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN l ON len(w) >= n),
        o AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM x),
        h AS (SELECT o.r, o.i, o.n, q.item FROM o JOIN q USING (n, phrase)),
        c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
        s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN s ON s.r = d.r
    """,
}
