"""From input files to deliverables, what is seen of a run that dies, and checks by observed counts."""

import os

import pytest

from textlab.operators import ingest
from textlab.plans import pipeline
from textlab.session import stored
from textlab.sources import sinks
from textlab.sources.delivery import Delivery, delivered, drop_former, manifest


def files(folder, missing=False, corpus=True):
    """A corpus with line breaks in quotes, two splits and a test file."""
    os.makedirs(folder, exist_ok=True)
    texts = [("poor families need help", "the weather is fine today")[i % 3 > 0] + f" word{i % 7}" for i in range(60)]
    rows = [f'{i}\t@@{i}\tkw\tus\t"{t}\nsecond ""line"""\t{0 if i % 3 else 3}' for i, t in enumerate(texts)]
    write = lambda name, lines: open(os.path.join(folder, name), "w", encoding="utf-8").write("\n".join(lines) + "\n")
    write("corpus.tsv", ["a disclaimer", *(rows if corpus else [])])
    write("train.csv", ["par_id,label", *(f"{i},{int(i % 3 == 0)}" for i in range(40))])
    write("dev.csv", ["par_id,label", *(f"{i},{int(i % 3 == 0)}" for i in range(59, 39, -1)), *(["900,1"] if missing else [])])
    write("test.tsv", [f"t_{i}\t@@{i}\tkw\tus\t{texts[-i]}" for i in range(25, 0, -1)] + ["q_1\t@@1\tk\tc\tnot a test row"])
    return [os.path.join(folder, n) for n in ("corpus.tsv", "train.csv", "dev.csv", "test.tsv")]


@pytest.fixture
def no_other_scans(monkeypatch):
    def never(*_, **__):
        raise AssertionError("a check by a scan of its own")

    monkeypatch.setattr(ingest, "require_rows", never)
    monkeypatch.setattr(ingest, "check_missing", never)


def test_run_from_files(spark, tmp_dir, no_other_scans):
    out = os.path.join(tmp_dir, "out")
    meta = pipeline.run_files(spark, *files(tmp_dir), out, multi_line=True)
    told = manifest(spark, out)
    assert told["number"] == 1 and told["meta"]["dev_f1"] == meta["dev_f1"] == 1.0
    assert told["tables"]["dev_lines"]["rows"] == 20 and told["tables"]["test_lines"]["rows"] == 25
    lines = [r["value"] for r in spark.read.text(delivered(spark, out, "dev_lines")).collect()]
    assert lines == [str(int(i % 3 == 0)) for i in range(59, 39, -1)]  # the order of the file
    merged = os.path.join(tmp_dir, "test.txt")
    sinks.merge_lines(spark, delivered(spark, out, "test_lines"), merged)
    assert open(merged).read().split() == [str(int((60 - i) % 3 == 0)) for i in range(25, 0, -1)]
    assert meta["test_positive_rate"] == pytest.approx(sum(map(int, open(merged).read().split())) / 25)
    detail = spark.read.parquet(delivered(spark, out, "dev_detail"))
    assert detail.filter("text like '%second \"line\"%'").count() == 20
    model = sinks.load_model(spark, delivered(spark, out, "model"))
    assert model.meta["dev_positive_rate"] == meta["dev_positive_rate"]
    assert {"dev_report", "local_evaluation", "false_positives", "false_negatives", "score_density", "leaderboard"} <= set(told["tables"])


def test_a_run_that_dies_is_not_seen(spark, tmp_dir, monkeypatch):
    out, paths = os.path.join(tmp_dir, "out"), files(tmp_dir)
    pipeline.run_files(spark, *paths, out, multi_line=True)
    before = manifest(spark, out)
    old = spark.read.parquet(delivered(spark, out, "dev_detail")).orderBy("record_id").collect()

    def dies(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "save_model", dies)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run_files(spark, *paths, out, multi_line=True)
    assert manifest(spark, out) == before
    for name in before["tables"]:
        assert os.path.isdir(delivered(spark, out, name))
    assert spark.read.parquet(delivered(spark, out, "dev_detail")).orderBy("record_id").collect() == old
    pipeline.run_files(spark, *paths, out, multi_line=True)
    assert manifest(spark, out)["number"] == 2 and manifest(spark, out)["run"] != before["run"]
    gone = drop_former(spark, out, keep=1)
    assert len(gone) == 2 and before["run"] in gone and manifest(spark, out)["number"] == 2
    assert spark.read.parquet(delivered(spark, out, "dev_detail")).count() == 20


def test_two_runs_do_not_share_a_number(spark, tmp_dir, monkeypatch):
    from textlab.sources import delivery

    a, b = Delivery(spark, tmp_dir), Delivery(spark, tmp_dir)
    assert a.commit() == 1
    monkeypatch.setattr(delivery, "_numbers", lambda *_: [])
    with pytest.raises(RuntimeError, match="same time"):
        b.commit()
    with pytest.raises(FileNotFoundError):
        manifest(spark, os.path.join(tmp_dir, "nothing"))


def test_checks_come_from_the_writes(spark, tmp_dir, no_other_scans):
    with pytest.raises(ValueError, match="dev_missing=1"):
        pipeline.run_files(spark, *files(os.path.join(tmp_dir, "a"), missing=True), os.path.join(tmp_dir, "o"), multi_line=True)
    with pytest.raises(ValueError, match="corpus: no valid record"):
        pipeline.run_files(spark, *files(os.path.join(tmp_dir, "b"), corpus=False), os.path.join(tmp_dir, "o"), multi_line=True)
    with pytest.raises(FileNotFoundError):
        manifest(spark, os.path.join(tmp_dir, "o"))
    none, seen = stored(spark.createDataFrame([], "a int"), "none")
    assert seen["rows"] == 0 and none.count() == 0
