"""Column functions against the Python semantics they reproduce."""

import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from textlab.functions import labels as L
from textlab.functions import scores as S
from textlab.functions import text as T


def py_strip(s):
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def py_terms(s):
    toks = re.findall(r"(?u)\b\w\w+\b", py_strip(s.lower()))
    return toks + [" ".join(toks[i:i + 2]) for i in range(len(toks) - 1)]


WS = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
TEXTS = [
    None, "", "  a  ", f"x{WS}y", "hello\tworld\n", "Ça va?  Très bien.", "naïve café — ok",
    "ﬁne ﬂow ½ ²", "한국어 텍스트", "Straße MÜNCHEN", "a b c d", "x_y z1 __", "İstanbul",
    "emoji 😀 here", "é" * 3 + " é", "tab\there", "line sep　wide",
]


def test_clean_text_matches_python(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(T.clean_text("t")).collect()]
    # words as white space separates them, one space apart
    assert got == [" ".join((t or "").split()) for t in TEXTS]


def test_token_count(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = [r[0] for r in df.select(T.token_count(T.clean_text("t"))).collect()]
    assert got == [len((t or "").split()) for t in TEXTS]


def test_normalize_and_terms_match_python(spark):
    texts = [t for t in TEXTS if t is not None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    norm = [r[0] for r in df.select(T.normalize_text("t")).collect()]
    assert norm == [py_strip(t.lower()) for t in texts]
    terms = [list(r[0]) for r in df.select(T.analyzed_terms(F.col("t"))).collect()]
    assert terms == [py_terms(t) for t in texts]


def test_enrich_and_truncate(spark):
    df = spark.createDataFrame([("k", "gb", "a b c"), (None, None, None)], "k string, c string, t string")
    got = [r[0] for r in df.select(T.enrich_text("k", "c", "t")).collect()]
    assert got == ["kw_k c_gb a b c", "kw_unk c_unk "]
    got = [r[0] for r in df.select(T.truncate_tokens(T.enrich_text("k", "c", "t"), 3)).collect()]
    assert got == ["kw_k c_gb a", "kw_unk c_unk "]  # at most 3 fields: unchanged


# Label text cases (FIXTURES.md): value -> binary label.
LABEL_CASES = [
    ("[1, 0, 0]", 1), ("[0,0]", 0), ("(0, 1)", 1), ("[0.5]", 0), ("[-1]", 1), ("1", 1),
    ("0", 0), ("2", 1), ("-1", 0), ("0.5", 1), ("True", 1), ("[1, 0", 1),
    ("2 apples", 0), ("abc", 0), ("", 0), (None, 0),
    ("2,0", 1), ("0, 0", 0), ("[2,]", 1), ("(2,)", 1), ("[+2]", 1), ("{1,2}", 0), ("{'a': 1}", 0), ("0x2", 1),
    ("0x0", 0), ("-0x2", 0), ("007", 0), ("01", 1), ("00", 0), ("2\t", 1), ("\u3000" + "1 ", 1), ("[2, 0]\n", 1),
    ("['2']", 1), ("['0', '0']", 0), ("b'1'", 0), ("1j", 0), ("'1'", 0), ("None", 0), ("1e3", 1), ("(3)", 1), ("[]", 0),
]


def test_binarize_label_cases(spark):
    df = spark.createDataFrame([(v,) for v, _ in LABEL_CASES], "l string")
    got = [r[0] for r in df.select(L.binarize_label("l")).collect()]
    assert got == [b for _, b in LABEL_CASES]


def test_na_tokens_and_coercion(spark):
    vals = ["NA", "n/a", "nan", "", "na", "1.5", "7", "x"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    nulled = [r[0] for r in df.select(L.null_tokens("v")).collect()]
    assert nulled == [None, None, None, None, "na", "1.5", "7", "x"]
    lab = [r[0] for r in df.select(L.to_label(L.null_tokens("v"))).collect()]
    assert lab == [None, None, None, None, None, 1, 7, None]


def test_numbers_that_are_no_decimals_or_do_not_fit(spark):
    vals = ["2d", "2f", "0x1p1", "1e10", "NaN", "Infinity", " 3 ", "+2", "1e0", "-1.9"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(L.to_label("v")).collect()] == [None, None, None, None, None, None, 3, 2, 1, -1]


def test_article_id(spark):
    df = spark.createDataFrame([("@@12",), ("12",), ("@@",), ("@@1a",)], "a string")
    assert [r[0] for r in df.select(L.article_id("a")).collect()] == [12, None, None, None]


def test_softmax_threshold_strength(spark):
    import numpy as np

    df = spark.createDataFrame([(0.0, 0.0), (-1.0, 3.0), (800.0, -800.0)], "a double, b double")
    got = [r[0] for r in df.select(S.softmax2("a", "b")).collect()]
    x = np.array([[0.0, 0.0], [-1.0, 3.0], [800.0, -800.0]])
    e = np.exp(x - x.max(1, keepdims=True))
    assert np.allclose(got, (e / e.sum(1, keepdims=True))[:, 1], rtol=0, atol=1e-15)
    df = spark.createDataFrame([(0.7, 0, 1), (0.2, 1, 0)], "s double, t int, p int")
    r = df.select(S.apply_threshold("s", 0.5).alias("a"), S.mistake_strength("s", "p").alias("m"),
                  S.outcome_group("t", "p").alias("g")).collect()
    assert [(x.a, x.m, x.g) for x in r] == [(1, 0.7, "true=0,pred=1"), (0, -0.2, "true=1,pred=0")]


@pytest.mark.parametrize("plan_fn", [
    lambda c: T.clean_text(c), lambda c: T.token_count(T.clean_text(c)), lambda c: T.word_tokens(c),
    lambda c: T.ngrams_1_2(T.word_tokens(c)), lambda c: L.binarize_label(c),
])
def test_native_functions_have_no_python_eval(spark, plan_fn):
    df = spark.createDataFrame([("a b",)], "t string").select(plan_fn(F.col("t")).alias("o"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan


def test_checkpoint_root_needs_a_shared_folder_on_a_cluster():
    from textlab.session import checkpoint_root

    class Conf:
        def __init__(self, v):
            self.v = v

        def get(self, key, default=None):
            return self.v if key == "spark.checkpoint.dir" else default

    class Ctx:
        def __init__(self, master, conf_dir=None):
            self.master, self.conf, self.dir = master, Conf(conf_dir), None

        def getCheckpointDir(self):
            return self.dir

        def getConf(self):
            return self.conf

        def setCheckpointDir(self, d):
            self.dir = d

    class Session:
        def __init__(self, ctx):
            self.sparkContext = ctx

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session(Ctx("yarn")))
    # a configured shared folder is used as given
    assert checkpoint_root(Session(Ctx("yarn", "hdfs://nn/ckpt/"))) == "hdfs://nn/ckpt"
    # local mode without a setting gets a folder of its own, recorded on the context
    ctx = Ctx("local[2]")
    root = checkpoint_root(Session(ctx))
    assert root and ctx.dir == root
