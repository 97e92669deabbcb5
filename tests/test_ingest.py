"""Readers, validity, keep-last dedupe, the split/corpus join."""

import os

import pytest
from pyspark.sql import functions as F

from textlab.operators import ingest
from textlab.sources import readers

# Malformed corpus fixture (FIXTURES.md): tab-separated lines -> kept or not.
CORPUS_LINES = [
    "disclaimer line",
    "1\t@@10\thomeless\tus\thello  world\t0",
    '2\t@@11\tin-need\tgb\t"quoted ""x"" y"\t3',
    "3\t@@12\ta\tb\tc\t2\textra",
    "4\t@@13\tk\tc",
    "5\tbad\tk\tc\ttxt\t1",
    "6\t@@14\tk\tc\t\t1.5",
    '7\t@@15\tk\tc\tlone " quote\t9',
    "9\t@@17\tk\tc\tz\t4",
]


def write(tmp_dir, name, lines):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return p


def test_malformed_corpus(spark, tmp_dir):
    path = write(tmp_dir, "corpus.tsv", CORPUS_LINES)
    df = ingest.parse_corpus(readers.read_corpus(spark, path))
    got = {r.record_id: (r.article_id, r.text, r.raw_label, r.binary_label_raw) for r in df.collect()}
    assert got == {
        1: (10, "hello world", 0, 0),
        2: (11, 'quoted "x" y', 3, 1),
        6: (14, "", 1, 0),
        9: (17, "z", 4, 1),
    }


def test_empty_corpus_raises(spark, tmp_dir):
    path = write(tmp_dir, "bad.tsv", ["disclaimer", "x\ty"])
    with pytest.raises(ValueError, match="no valid record"):
        ingest.parse_corpus(readers.read_corpus(spark, path))


def test_test_reader(spark, tmp_dir):
    path = write(tmp_dir, "test.tsv", ["t_0\t@@5\tkw\tus\thi  there", "q_1\t@@6\tkw\tus\tx", "t_2\t7\tkw\tus\ty"])
    df = ingest.parse_test(readers.read_test(spark, path))
    assert [(r.sample_id, r.article_id, r.text) for r in df.collect()] == [("t_0", 5, "hi there")]
    bad = write(tmp_dir, "test_bad.tsv", ["t_0\t@@5\tkw\tus\thi\textra"])
    with pytest.raises(Exception, match="more than 5 fields"):
        readers.read_test(spark, bad).select("sample_id").collect()
    empty = write(tmp_dir, "test_tab.tsv", ["t_0\t@@5\tkw\tus\thi\t"])
    with pytest.raises(Exception, match="more than 5 fields"):
        readers.read_test(spark, empty).count()
    two = write(tmp_dir, "test_two.tsv", ['t_0\t@@5\tkw\tus\t"one', 'two\tthree"', "t_1\t@@6\tkw\tus\tx"])
    assert ingest.parse_test(readers.read_test(spark, two, multi_line=True)).count() == 2


def test_fields_are_counted(spark, tmp_dir):
    lines = ["1\t@@10\tk\tc\ttext\t2\t", '2\t@@10\tk\tc\t"a\tb"\t2', '3\t@@10\tk\tc\t"a\tb"\t2\t', "4\t@@10\tk\tc\tx\t2"]
    path = write(tmp_dir, "tabs.tsv", lines)
    for select in (["record_id"], ["record_id", "text"], ["*"]):
        assert sorted(r.record_id for r in readers.read_corpus(spark, path).select(*select).collect()) == ["2", "4"]
    assert readers.read_corpus(spark, path).count() == 2


def test_records_over_several_lines(spark, tmp_dir):
    path = write(tmp_dir, "lines.tsv", ['1\t@@10\tk\tc\t"line one', 'line ""two"""\t3', "2\t@@11\tk\tc\tx\t0"])
    with pytest.raises(Exception, match="runs over the end of a line"):
        readers.read_corpus(spark, path).collect()
    got = ingest.parse_corpus(readers.read_corpus(spark, path, multi_line=True)).orderBy("record_id").collect()
    assert [(r.record_id, r.text, r.raw_label) for r in got] == [(1, 'line one line "two"', 3), (2, "x", 0)]


def test_lines_are_numbered_without_gaps(spark, tmp_dir):
    from textlab.operators.ordering import number_by_position

    lines = ["1\t@@1\tk\tc\ta\t0", "2\t@@1\tk\tc\tb\t0", "3\t@@1\tk\tc\tc\t0\textra", "4\t@@1\tk\tc\td\t0", "5\t@@1\tk\tc\te\t0"]
    got = number_by_position(readers.read_corpus(spark, write(tmp_dir, "n.tsv", lines)), "_ord").collect()
    assert sorted((r.line, r.record_id) for r in got) == [(0, "1"), (1, "2"), (2, "4"), (3, "5")]


def test_merged_lines(spark, tmp_dir):
    from textlab.sources.sinks import merge_lines, write_lines

    df = spark.createDataFrame([(i, i % 3) for i in range(200)], "i int, v int").repartition(5)
    write_lines(df, f"{tmp_dir}/lines", "v", "i")
    merge_lines(spark, f"{tmp_dir}/lines", f"{tmp_dir}/all.txt")
    with open(f"{tmp_dir}/all.txt") as f:
        assert f.read().split() == [str(i % 3) for i in range(200)]


def test_scored_csv_is_typed(spark, tmp_dir):
    from textlab.sources.sinks import write_scored

    df = spark.createDataFrame([(1, 0, 1, 9.5, "a\nb"), (2, 0, 1, 10.5, "c"), (3, 0, 1, -2.0, "")], "record_id long, y_true int, y_pred int, score double, text string")
    write_scored(df, f"{tmp_dir}/scored", "csv")
    back = readers.read_scored(spark, f"{tmp_dir}/scored", "csv")
    assert dict(back.dtypes) == dict(df.dtypes)
    assert [r.score for r in back.orderBy(F.desc("score")).collect()] == [10.5, 9.5, -2.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_split_ids_that_are_no_numbers_raise(spark, ansi):
    raw = spark.createDataFrame([("x1", "0", 1), ("y2", "1", 2)], "par_id string, label string, _ord int")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="not a number"):
            ingest.parse_split(raw).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_split_reader_keep_last_and_required_columns(spark, tmp_dir):
    path = write(tmp_dir, "split.csv", ["par_id,label", '1,"[0, 0, 1]"', "2,0", "1,0", "3,", '2,"[1, 0"'])
    df = ingest.parse_split(readers.read_split(spark, path)).orderBy("record_id")
    assert [(r.record_id, r.binary_label, r.label_raw) for r in df.collect()] == [
        (1, 0, "0"), (2, 1, "[1, 0"), (3, 0, "nan")]
    bad = write(tmp_dir, "split_bad.csv", ["id,label", "1,0"])
    with pytest.raises(ValueError, match="no column par_id"):
        readers.read_split(spark, bad)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_keep_last_independent_of_partitioning(spark, parts):
    rows = [(i % 7, i, f"v{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "k int, _ord int, v string").repartition(parts)
    got = {r.k: r.v for r in ingest.dedupe_keep_last(df, "k").collect()}
    assert got == {k: f"v{max(i for i in range(200) if i % 7 == k)}" for k in range(7)}


def test_labelled_split_paths_agree(spark):
    split = spark.createDataFrame([(1, 1), (2, 0), (5, 1)], "record_id long, binary_label int")
    corpus = spark.createDataFrame(
        [(1, 10, "k", "c", "a"), (1, 11, "k", "c", "b"), (2, 12, "k", "c", "c"), (3, 13, "k", "c", "d")],
        "record_id long, article_id long, keyword string, country string, text string")
    small = ingest.labelled_split(split, corpus)
    big = ingest.labelled_split(split, corpus, broadcast_max_bytes=0)
    key = lambda r: (r.record_id, r.article_id or -1)
    a, b = sorted(small.collect(), key=key), sorted(big.collect(), key=key)
    assert a == b
    assert [(r.record_id, r.text) for r in a] == [(1, "a"), (1, "b"), (2, "c"), (5, None)]
    with pytest.raises(ValueError, match="missing"):
        ingest.raise_on_missing(small.withColumn("split", F.lit("train")))


def test_skew_safe_left_join_matches_plain_join(spark):
    # key 7 is hot (50 corpus rows, 5 buckets of 10) and has two split rows;
    # key 1 is hot too (2 rows, hot_rows=1); key 5 has no corpus row
    left = spark.createDataFrame([(1, 1), (2, 0), (5, 1), (7, 0), (7, 1)], "record_id long, binary_label int")
    rows = [(7, i, "k", "c", f"t{i % 3}") for i in range(50)]
    rows += [(1, 10, "k", "c", "a"), (1, 11, "k", "c", "b"), (2, 12, "k", "c", "c"), (3, 13, "k", "c", "d")]
    right = spark.createDataFrame(rows, "record_id long, article_id long, keyword string, country string, text string")
    plain = left.join(right, "record_id", "left")
    for hot_rows in (1, 10):
        got = ingest.skew_safe_left_join(left, right, "record_id", hot_rows=hot_rows)
        assert got.columns == plain.columns
        assert sorted(got.collect()) == sorted(plain.collect()) and got.count() == 104


def test_union_splits(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    got = sorted((r.x, r.split) for r in ingest.union_splits(train=a, dev=b).collect())
    assert got == [(1, "train"), (2, "dev")]


@pytest.mark.parametrize("piece", [1 << 20, 256])
def test_bloom_filter_keeps_every_key(spark, monkeypatch, piece):
    monkeypatch.setattr(ingest, "BLOOM_PIECE", piece)
    keys = spark.createDataFrame([(i * i,) for i in range(-300, 3000)] + [(None,)], "record_id long").repartition(3)
    rows = spark.range(-1000, 60_000).select(F.col("id").alias("record_id"), F.lit("text").alias("text"))
    got = {r["record_id"] for r in ingest.bloom_filtered(rows, keys, "record_id").collect()}
    asked = {i * i for i in range(3000)} & set(range(60_000))
    assert asked <= got
    assert len(got - asked) < 0.03 * 61_000
    # a filter far too small lets more through, and still every key
    small = {r["record_id"] for r in ingest.bloom_filtered(rows, keys, "record_id", max_bytes=1024).collect()}
    assert asked <= small and len(small) > len(got)
    assert ingest.bloom_filtered(rows, keys.limit(0), "record_id").count() == 0


def test_large_split_shuffles_few_corpus_rows(spark):
    corpus = spark.range(0, 20_000).select(
        F.col("id").alias("record_id"), F.col("id").alias("article_id"), F.lit("k").alias("keyword"), F.lit("c").alias("country"),
        F.concat(F.lit("text "), "id").alias("text"))
    split = spark.createDataFrame([(i, i % 2, "x") for i in range(0, 30_000, 100)], "record_id long, binary_label int, label_raw string")
    joined = ingest.labelled_split(split, corpus, broadcast_max_bytes=0)
    plain = split.join(corpus, "record_id", "left").select(*joined.columns)
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("may_hold") :]
    assert "ArrowEvalPython" in plan and "Exchange" not in below.split("Range (0, 20000")[0].split("ArrowEvalPython")[-1]
    kept = ingest.bloom_filtered(corpus, split, "record_id").count()
    assert 200 <= kept < 200 + 0.03 * 20_000
