"""Line breaks in quoted fields, read in splits, against one reading of the whole file."""

import csv
import os
import random

import pytest
from pyspark import TaskContext

from textlab.operators import ingest
from textlab.operators.ordering import number_by_position
from textlab.sources import quoted, readers
from textlab.sources.quoted import quoted_records, split_states


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes, whatever the size of the files."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.openCostInBytes", "1")

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))

    yield size
    for k, v in old.items():
        spark.conf.set(k, v)


def one_reading(path, sep="\t"):
    with open(path, encoding="utf-8", newline="") as f:
        return [[x.replace("\r\n", "\n") for x in r] for r in csv.reader(f, delimiter=sep) if r]


def wild(seed, n=120):
    """Records with breaks, doubled quotes, lone quotes, separators and text after a closing quote."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        text = rnd.choice([
            "plain words", 'lone " quote', '"one\nbreak"', '"a ""quoted"" word"', '"tab\there"', '"three\n\nbreaks ""\n"', '"closed" and "more',
            '""', '"""\n"""', '"x\n' * 1 + 'y"', "", '"ends with ""\n"', "é漢字",
        ])
        out.append(f"{i}\t@@{i}\t{rnd.choice(['k', '', NA])}\tus\t{text}\t{i % 5}")
    return "\n".join(out) + "\n"


NA = "NA"


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("size", [64, 300, 1500, 1 << 20])
def test_splits_equal_one_reading(spark, tmp_dir, splits, size):
    path = write(tmp_dir, "wild.tsv", wild(3))
    splits(size)
    records = quoted_records(spark, path)
    if size < 1500:
        assert records.rdd.getNumPartitions() > 3
    numbered = number_by_position(records, "_ord").orderBy("line").collect()
    assert [r["line"] for r in numbered] == list(range(len(numbered)))
    assert [next(csv.reader(r["_record"].splitlines(True), delimiter="\t")) for r in numbered] == one_reading(path)
    assert [r["_head"] for r in numbered] == [True] + [False] * (len(numbered) - 1)
    got = readers.read_corpus(spark, path, multi_line=True)
    want = [r for r in one_reading(path)]
    null = lambda x: None if x in ("", NA) else x
    found = {r["record_id"]: tuple(r[c] for c in readers.CORPUS_COLUMNS) for r in got.collect()}
    assert found == {r[0]: tuple(null(x) for x in r) for r in want if len(r) <= 6}


def test_several_files_and_windows_line_ends(spark, tmp_dir, splits):
    folder = os.path.join(tmp_dir, "many")
    os.makedirs(folder)
    paths = [write(folder, f"f{i}.tsv", wild(i, 30)) for i in range(4)] + [write(folder, "f9.tsv", wild(9, 30).replace("\n", "\r\n"))]
    splits(200)
    got = sorted(tuple(next(csv.reader(r["_record"].splitlines(True), delimiter="\t"))) for r in quoted_records(spark, folder).collect())
    assert got == sorted(tuple(r) for p in paths for r in one_reading(p))
    assert quoted_records(spark, folder).filter("_head").count() == 5


def test_a_record_over_several_splits(spark, tmp_dir, splits):
    text = "1\t@@1\tk\tc\t\"" + "\n".join(f"line {i}" for i in range(40)) + "\"\t3\n2\t@@2\tk\tc\tx\t0\n"
    path = write(tmp_dir, "long.tsv", text)
    splits(70)
    assert split_states(spark, path, "\t").filter("crossed > 0").count() > 1
    got = ingest.parse_corpus(readers.read_corpus(spark, path, multi_line=True)).orderBy("record_id").collect()
    assert [(r["record_id"], r["text"], r["raw_label"]) for r in got] == [(1, " ".join(f"line {i}" for i in range(40)), 3), (2, "x", 0)]


def test_a_lone_quote_fails_loudly(spark, tmp_dir, splits, monkeypatch):
    rows = "".join(f"{i}\t@@1\tk\tc\tsome text here\t0\n" for i in range(60))
    splits(200)
    path = write(tmp_dir, "lone.tsv", rows + '70\t@@1\tk\tc\t"never closed\t0\n' + rows)
    with pytest.raises(ValueError, match="not closed"):
        readers.read_corpus(spark, path, multi_line=True)
    # closed by chance far below: the record covers too many splits
    path = write(tmp_dir, "far.tsv", '70\t@@1\tk\tc\t"never closed\t0\n' + rows + '71\t@@1\tk\tc\tx"\t0\n')
    monkeypatch.setattr(quoted, "MAX_SPLITS", 3)
    with pytest.raises(ValueError, match="not closed"):
        readers.read_corpus(spark, path, multi_line=True)


def test_scored_csv_is_read_in_splits(spark, tmp_dir, splits):
    from textlab.sources.sinks import write_scored

    rows = [(i, i % 2, i % 3 % 2, i / 7, ['a "b"\n, c', "x,y", "line\n\nbreak", "plain"][i % 4]) for i in range(50)]
    df = spark.createDataFrame(rows, "record_id long, y_true int, y_pred int, score double, text string").repartition(2)
    path = os.path.join(tmp_dir, "scored")
    write_scored(df, path, fmt="csv")
    splits(150)
    back = readers.read_scored(spark, path, fmt="csv")
    assert back.dtypes == df.dtypes and back.rdd.getNumPartitions() > 4
    assert sorted(map(tuple, back.collect())) == rows


def test_an_empty_file(spark, tmp_dir, splits):
    assert quoted_records(spark, write(tmp_dir, "none.tsv", "")).count() == 0


def test_a_filter_on_fields_takes_no_record_apart_again(spark, tmp_dir):
    path = write(tmp_dir, "wild.tsv", wild(5))
    df = ingest.valid_corpus(readers.read_corpus(spark, path, multi_line=True))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    want = {r[0] for r in one_reading(path) if len(r) == 6}
    assert {r["record_id"] for r in df.collect()} == want


def test_the_empty_guard_stops_at_the_first_partition_with_rows(spark, tmp_dir):
    def work(batches):
        os.makedirs(os.path.join(tmp_dir, f"part-{TaskContext.get().partitionId()}"), exist_ok=True)
        yield from batches

    df = spark.range(800, numPartitions=8).join(spark.range(800).hint("broadcast"), "id").mapInArrow(work, "id long")
    assert ingest.require_rows(df, "rows") is df
    assert os.listdir(tmp_dir) == ["part-0"]
    with pytest.raises(ValueError, match="no valid record"):
        ingest.require_rows(df.filter("id < 0"), "rows")
