"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the target over its share of
the corpus.  Each document's number of copies is the Poisson quantile of a
number that a seeded hash of its id gives, so it depends on nothing but the id,
the seed and the rate; the copies are dealt into a global order by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

SEED = "mix-1"
#: A rate above this is made up of several draws, so that its terms don't underflow.
DRAW_RATE = 256.0
#: Rates of at most so many sources, and so many bytes of their names, are broadcast; beyond that the join is salted.
BROADCAST_SOURCES, BROADCAST_BYTES, SALTS = 100_000, 8 << 20, 64
#: So many repeated ids, or hashes of rows listed more than once, are broadcast; more are joined by a shuffle.
KEYS_BROADCAST = 500_000
#: Identical rows that one step numbers at a time.
BLOCK = 100_000


def uniform(key: Column, what: Column) -> Column:
    """A number in [0, 1) of 52 hashed bits."""
    hexes = F.substring(F.md5(F.concat_ws(":", F.lit(SEED), key, what).cast("binary")), 1, 13)
    return F.conv(hexes, 16, 10).cast("long") / F.lit(4503599627370496.0)


def free_name(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None, source_col: str, text_col: str, budget: float | None) -> DataFrame:
    """(source, rate, draws, cdf) for each source of `docs`, over all rows."""
    mass = F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) + 1
    masses = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(mass).alias("mass"))
    if weights is None:
        masses = masses.withColumn("weight", F.lit(1.0))
    else:
        if any(w < 0 for w in weights.values()):
            raise ValueError("weights must not be negative")
        given = docs.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], "given string, weight double")
        masses = masses.join(given, F.col("source").eqNullSafe(F.col("given")), "left").drop("given").fillna(0.0, ["weight"])
    total = masses.agg(F.sum("mass").alias("total"), F.sum("weight").alias("weights"))
    share = F.try_divide(F.col("weight"), F.col("weights"))  # null where all weights are 0
    rate = F.coalesce(F.lit(budget).cast("double"), F.col("total").cast("double")) * share / F.col("mass")
    rates = masses.crossJoin(F.broadcast(total)).select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))
    rates = rates.withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / DRAW_RATE)).cast("int"))
    part = F.col("rate") / F.col("draws")
    terms = F.sequence(F.lit(1), F.ceil(part + 12 * F.sqrt(part) + 24).cast("int"))
    start = F.struct(F.exp(-part).alias("p"), F.array(F.exp(-part)).alias("c"))

    def add(acc: Column, k: Column) -> Column:
        p = acc["p"] * part / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return rates.withColumn("cdf", F.aggregate(terms, start, add, lambda acc: acc["c"]))


def few(df: DataFrame) -> tuple[DataFrame, int]:
    df = cut(df)
    n = df.count()
    return (F.broadcast(df) if n <= KEYS_BROADCAST else df), n


def with_keys(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """`docs` with the key of each row's draws: its id; under a null or repeated id also a hash of the row and its number among identical rows."""
    columns = docs.columns
    again, content, twins, n, block = (free_name(docs, c) for c in ("id_again", "row_hash", "row_twin", "row_n", "row_block"))
    doc = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    ids, many = few(docs.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(again)).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).select(again))
    shared = F.col(id_col).isNull()
    if many:
        docs, shared = docs.join(ids, F.col(id_col) == F.col(again), "left"), shared | F.col(again).isNotNull()
    cells = (F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in columns)
    whole = F.md5(F.concat_ws("\x1f", *cells).cast("binary"))
    hashed = docs.select(*columns, F.when(shared, whole).alias(content))
    key = lambda number: F.concat_ws(":", doc, content, number)
    listed, many = few(hashed.filter(F.col(content).isNotNull()).groupBy(F.col(content).alias(twins)).agg(F.count(F.lit(1)).alias(n)).filter(F.col(n) > 1).select(twins))
    on = F.col(content) == F.col(twins)
    once = hashed.join(listed, on, "left_anti") if many else hashed
    once = once.select(*columns, F.when(F.col(content).isNull(), doc).otherwise(key(F.lit("1"))).alias(name))
    if not many:
        return once
    # identical rows become one row with their number, which combines map-side, and are dealt out again in blocks
    grouped = hashed.join(listed, on, "left_semi").groupBy(content).agg(*(F.first(c).alias(c) for c in columns), F.count(F.lit(1)).alias(n))
    blocks = grouped.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / BLOCK))))
    last = F.least(F.col(n), (F.col(block) + 1) * BLOCK)
    numbered = blocks.withColumn(block, F.explode(F.sequence(F.col(block) * BLOCK + 1, last)))
    return once.unionByName(numbered.select(*columns, key(F.col(block).cast("string")).alias(name)))


def poisson_mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    budget: float | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    by_row: bool = False,
) -> DataFrame:
    """All columns of `docs`, one row per copy, with copy (from 1) and shuffle_key, in the order of shuffle_key.

    A source's mean number of copies is budget * weight / mass, where mass is
    its characters plus one per document, weights are scaled to sum to 1
    (default: equal for all sources present; sources without a given weight get
    0) and budget defaults to the mass of all documents.  A null source is a
    source of its own.  The number of copies follows from doc_id alone, a null
    doc_id counting as the text "null"; repeated rows are each copied.  With
    `by_row`, rows under a null or repeated doc_id draw each for itself: the
    key of the draws and of shuffle_key then also holds a hash of all columns
    and a number among identical rows.  Null and
    empty texts have mass 1.  Added columns get leading underscores where `docs`
    has their names.  An empty table gives no rows.
    """
    own = free_name(docs, "draw_key")
    plain = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    rates = cut(source_rates(docs, weights, source_col, text_col, budget))
    docs = with_keys(docs, id_col, own) if by_row else docs.withColumn(own, plain)
    n, size = rates.agg(F.count(F.lit(1)), F.sum(F.octet_length(F.coalesce("source", F.lit(""))))).first()
    src, draws, cdf, copy, key = (free_name(docs, c) for c in ("rate_source", "rate_draws", "rate_cdf", "copy", "shuffle_key"))
    rates = rates.select(F.col("source").alias(src), F.col("draws").alias(draws), F.col("cdf").alias(cdf))
    on = F.col(source_col).cast("string").eqNullSafe(F.col(src))
    if n <= BROADCAST_SOURCES and (size or 0) <= BROADCAST_BYTES:
        rated = docs.join(F.broadcast(rates), on)
    else:
        salt, each = free_name(docs, "rate_salt"), free_name(docs, "rate_each")
        salted = rates.withColumn(each, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = docs.withColumn(salt, F.pmod(F.xxhash64(own, text_col), F.lit(SALTS)).cast("int"))
        rated = dealt.join(salted, on & (F.col(salt) == F.col(each))).drop(salt, each)
    doc = F.col(own)

    def draw(acc: Column, j: Column) -> Column:
        u = uniform(doc, j.cast("string"))
        return acc + F.size(F.filter(F.col(cdf), lambda c: c <= u))

    count = F.aggregate(F.sequence(F.lit(1), F.col(draws)), F.lit(0), draw)
    copies = rated.withColumn(copy, count).filter(F.col(copy) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
    mixed = copies.withColumn(key, F.md5(F.concat_ws(":", F.lit(SEED), doc, F.lit("copy"), F.col(copy).cast("string")).cast("binary")))
    tie = free_name(mixed, "shuffle_tie")  # rows that share a shuffle_key don't have to share a task
    mixed = mixed.withColumn(tie, F.xxhash64(text_col)).drop(src, draws, cdf, own)
    return mixed.repartitionByRange(key, tie).sortWithinPartitions(key, tie, copy).drop(tie)
