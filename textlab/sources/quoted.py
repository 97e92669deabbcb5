"""Records whose quoted fields hold line breaks, read in splits.

Whether a line begins a record or goes on inside a quoted field depends on all
lines before it.  But a line is one of few functions of that state, and such
functions compose, so a first scan reduces each split to what it makes of
either state; the summaries of a file, one per split, give the state in which
each split begins.  With it, a second scan puts together the records that
begin and end in a split, and only the pieces of a record that crosses a
boundary meet in an exchange.

A quote opens a quoted field only at the start of a field, two quotes inside
one stand for a quote, and text after the closing quote is taken as it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: Splits that a record may cover; a longer one is a quote that was never closed.
MAX_SPLITS = 8

OUTSIDE, INSIDE = 0, 1


def without_quoted(text: Column, sep: str) -> Column:
    """The text without its complete quoted fields; a quote left at the start of a field is never closed."""
    return F.when(F.contains(text, F.lit('"')), F.regexp_replace(text, rf'(^|{sep})"[^"]*+(?:""[^"]*+)*+"', "$1")).otherwise(text)


def is_open(text: Column, sep: str) -> Column:
    return F.contains(text, F.lit('"')) & without_quoted(text, sep).rlike(f'(^|{sep})"')


def lines(spark: SparkSession, path, sep: str) -> DataFrame:
    """Lines in file order within a split, and the state after each for either state before."""
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    closing = r'^[^"]*+(?:""[^"]*+)*+"'
    rest = F.concat(F.lit("x"), F.regexp_replace("value", closing, ""))  # goes on in the field that was closed
    return raw.select(
        "*",
        is_open(F.col("value"), sep).cast("int").alias("if_outside"),
        F.when(F.contains("value", F.lit('"')) & F.col("value").rlike(closing), is_open(rest, sep).cast("int")).otherwise(F.lit(INSIDE)).alias("if_inside"),
    )


def states(start: int, if_outside: np.ndarray, if_inside: np.ndarray) -> np.ndarray:
    """The state before each line, and after the last."""
    n = len(if_outside)
    fixed = if_outside == if_inside
    turns = np.concatenate([[0], np.cumsum(~fixed & (if_outside == INSIDE))])  # lines that turn either state
    at = np.maximum.accumulate(np.concatenate([[0], np.where(fixed, np.arange(1, n + 1), 0)]))  # after the last line that sets it
    known = np.concatenate([[start], if_outside])[at]
    return known ^ ((turns - turns[at]) & 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """The lines of each split, in order."""
    file = batch.column(batch.schema.get_field_index("file")).dictionary_encode().indices.to_numpy()
    block = batch.column(batch.schema.get_field_index("block")).to_numpy()
    edge = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
    for a, b in zip([0, *edge], [*edge, batch.num_rows]):
        if b > a:
            part = batch.slice(a, b - a)
            yield part.column(part.schema.get_field_index("file"))[0].as_py(), int(block[a]), part


def split_states(spark: SparkSession, path, sep: str) -> DataFrame:
    """(file, block, state, owner, ends): the state in which each split begins, the split whose record goes on
    there, and the state after it.  Raises where a file ends inside a quoted field or a record covers too many splits."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[str, int], list] = {}
        for batch in batches:
            for file, block, part in _runs(batch):
                ends = seen.setdefault((file, block), [OUTSIDE, INSIDE, False, False])
                maps = [part.column(part.schema.get_field_index(c)).to_numpy() for c in ("if_outside", "if_inside")]
                for k in (OUTSIDE, INSIDE):
                    found = states(ends[k], *maps)
                    ends[2 + k] |= bool((found[:-1] == OUTSIDE).any())
                    ends[k] = int(found[-1])
        rows = [(*key, *ends) for key, ends in seen.items()]
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["file", "block", "from_out", "from_in", "begins_out", "begins_in"])

    made = lines(spark, path, sep).drop("value", "row").mapInArrow(
        work, "file string, block long, from_out int, from_in int, begins_out boolean, begins_in boolean"
    )
    # the splits of a file in a row: state before each, and the last split before it in which a record begins
    ordered = made.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("block", "from_out", "from_in", "begins_out", "begins_in"))).alias("s"))
    first = F.struct(F.lit(OUTSIDE).alias("state"), F.lit(0).cast("long").alias("owner"), F.lit(0).alias("crossed"), F.expr(
        "cast(array() as array<struct<block:bigint,state:int,owner:bigint,ends:int,crossed:int>>)").alias("done"))

    def step(acc: Column, x: Column) -> Column:
        inside = acc["state"] == INSIDE
        ends = F.when(inside, x["from_in"]).otherwise(x["from_out"])
        begins = F.when(inside, x["begins_in"]).otherwise(x["begins_out"])
        crossed = F.when(inside & ~begins, acc["crossed"] + 1).otherwise(F.lit(0))
        row = F.struct(x["block"].alias("block"), acc["state"].alias("state"), acc["owner"].alias("owner"), ends.alias("ends"), crossed.alias("crossed"))
        return F.struct(ends.alias("state"), F.when(begins, x["block"]).otherwise(acc["owner"]).alias("owner"), crossed.alias("crossed"), F.concat(acc["done"], F.array(row)).alias("done"))

    table = ordered.select("file", F.aggregate("s", first, step).alias("end"))
    checkpoint_root(spark)
    table = table.checkpoint()
    lost = table.filter((F.col("end.state") == INSIDE) | F.exists("end.done", lambda x: x["crossed"] >= MAX_SPLITS)).select("file").limit(1).collect()
    if lost:
        raise ValueError(f"{lost[0]['file']}: a quoted field is not closed")
    return table.select("file", F.inline("end.done"))


def quoted_records(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """(_record, _ord, _head): the records of delimited files, line breaks inside quoted fields as `\\n`, blank records left out.

    _ord is the position of a record's first line as in the other readers, _head
    marks the first record of a file.  One scan of the files runs at once;
    reading the result is another.
    """
    table = split_states(spark, path, sep)
    crossing = table.filter(f"ends = {INSIDE} or state = {INSIDE}")

    def assembled(table: DataFrame, whole: bool) -> DataFrame:
        # a row per split of some MB: small beside the files
        placed = lines(spark, path, sep).join(F.broadcast(table.select("file", "block", "state", "owner", "ends")), ["file", "block"])

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, state, held, fresh = None, OUTSIDE, None, True  # held: the open record (position, lines), position None where it began before

            def out(rows: list[tuple]) -> pa.RecordBatch:
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                names = ["_record", "file", "block", "row", "owner", "_head"]
                return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

            def closed(last: bool) -> Iterator[tuple]:
                """The held record: whole, or a piece of the record that began in block `owner`."""
                file, block, owner, ends = now
                row, held_lines, head = held
                piece = row is None or (last and ends == INSIDE)
                if held_lines and piece != whole:
                    yield "\n".join(held_lines), file, block, -1 if row is None else row, owner if row is None else block, head

            for batch in batches:
                rows: list[tuple] = []
                for file, block, part in _runs(batch):
                    col = lambda c: part.column(part.schema.get_field_index(c))  # noqa: B023,E731
                    if now is None or (file, block) != now[:2]:
                        fresh = True
                        if held is not None:
                            rows += closed(True)
                        state, owner, ends = (col(c)[0].as_py() for c in ("state", "owner", "ends"))
                        now, held = (file, block, owner, ends), (None, [], False)
                    found = states(state, col("if_outside").to_numpy(), col("if_inside").to_numpy())
                    state = int(found[-1])
                    begins = np.flatnonzero(found[:-1] == OUTSIDE)
                    values, ids = col("value").to_pylist(), col("row").to_pylist()
                    edge = [*begins, len(values)]
                    held[1].extend(values[: edge[0]])
                    for a, b in zip(edge[:-1], edge[1:]):
                        rows += closed(False)
                        held = (ids[a], values[a:b], fresh and a == 0 and block == 0)
                    fresh = False
                if rows:
                    yield out(rows)
            if held is not None:
                yield out(list(closed(True)))

        return placed.mapInArrow(work, "_record string, file string, block long, row long, owner long, _head boolean")

    position = F.struct(F.col("file"), F.col("block"), F.col("row")).alias("_ord")
    found = assembled(table, True).select("_record", position, "_head")
    if not crossing.isEmpty():
        pieces = assembled(crossing, False).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "row", "_record", "_head"))).alias("p"))
        joined = pieces.select(
            F.array_join(F.transform("p", lambda x: x["_record"]), "\n").alias("_record"),
            F.struct(F.col("file"), F.col("owner").alias("block"), F.col("p")[0]["row"].alias("row")).alias("_ord"),
            F.col("p")[0]["_head"].alias("_head"),
        )
        found = found.unionByName(joined)
    return found.filter(F.length("_record") > 0)
