"""Registry of queries: one per operator of the inventory, each (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import ingest, profile
from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def eda_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """train + dev splits joined to the corpus, with token counts (profile input)."""
    split = fx.split_labels(spark, sf_dir).filter(F.col("split").isin("train", "dev"))
    joined = ingest.labelled_split(split, fx.corpus(spark, sf_dir))
    return joined.withColumn("token_count", T.token_count("text"))


@query("token_stats")
def q_token_stats(spark, sf_dir):
    return profile.token_stats(eda_frame(spark, sf_dir))


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------
def R(c, d: int = 9) -> F.Column:
    """Round a float result so sums taken in another order still compare equal.

    Rounded as round(x * 10^d) -> bigint -> / 10^d: integer steps plus one IEEE
    division, so every engine lands on the same double.
    """
    scale = F.lit(float(10 ** d))
    return F.round((F.col(c) if isinstance(c, str) else c) * scale).cast("bigint") / scale


def raw_corpus_na(spark, sf_dir):
    from ..sources.readers import CORPUS_COLUMNS, with_na_tokens
    return with_na_tokens(fx.raw_corpus(spark, sf_dir), CORPUS_COLUMNS)


def parsed_corpus(spark, sf_dir):
    return ingest.parse_corpus(raw_corpus_na(spark, sf_dir), check=False).drop("_ord")


def parsed_split(spark, sf_dir):
    return ingest.parse_split(fx.raw_split(spark, sf_dir)).drop("_ord")


def scored(spark, sf_dir, with_text=False):
    return fx.scored_fixture(spark, sf_dir, with_text)


# ---------------------------------------------------------------------------
# S5, P1, P2, P4, F1-F9, W1, J1, U1
# ---------------------------------------------------------------------------
@query("null_tokens")
def q_null_tokens(spark, sf_dir):
    return raw_corpus_na(spark, sf_dir).select("doc_id", "record_id", "article_id", "keyword", "country", "raw_label")


@query("valid_records")
def q_valid_records(spark, sf_dir):
    return parsed_corpus(spark, sf_dir)


@query("valid_test_records")
def q_valid_test_records(spark, sf_dir):
    from ..sources.readers import TEST_COLUMNS, with_na_tokens
    raw = with_na_tokens(fx.raw_test(spark, sf_dir), TEST_COLUMNS)
    return ingest.parse_test(raw, check=False).drop("_ord")


@query("clean_text")
def q_clean_text(spark, sf_dir):
    (docs,) = fx.tables(spark, sf_dir, "documents")
    return docs.select("doc_id", T.clean_text("text").alias("text"))


@query("article_id")
def q_article_id(spark, sf_dir):
    from ..functions.labels import article_id
    return raw_corpus_na(spark, sf_dir).select(
        "doc_id", F.col("article_id").alias("article_id_raw"),
        # double: a null-bearing integer column compares the same way in both engines
        article_id("article_id").cast("double").alias("article_id"),
    )


@query("coerce_label")
def q_coerce_label(spark, sf_dir):
    from ..functions.labels import to_label
    return raw_corpus_na(spark, sf_dir).select("doc_id", "raw_label", to_label("raw_label").cast("double").alias("label"))


@query("severity_label")
def q_severity_label(spark, sf_dir):
    return parsed_corpus(spark, sf_dir).select("record_id", "raw_label", "binary_label_raw")


@query("binarize_label")
def q_binarize_label(spark, sf_dir):
    from ..functions.labels import binarize_label, label_raw
    raw = fx.raw_split(spark, sf_dir, with_duplicates=False)
    return raw.select(
        F.col("par_id").cast("bigint").alias("record_id"),
        label_raw("label").alias("label_raw"),
        binarize_label("label").alias("binary_label"),
    )


@query("token_count")
def q_token_count(spark, sf_dir):
    (docs,) = fx.tables(spark, sf_dir, "documents")
    return docs.select("doc_id", T.token_count(T.clean_text("text")).alias("token_count"))


@query("enrich_text")
def q_enrich_text(spark, sf_dir):
    c = parsed_corpus(spark, sf_dir)
    return c.select("record_id", T.enrich_text("keyword", "country", "text").alias("text"))


@query("truncate_tokens")
def q_truncate_tokens(spark, sf_dir):
    c = parsed_corpus(spark, sf_dir)
    return c.select("record_id", T.truncate_tokens(T.enrich_text("keyword", "country", "text"), 256).alias("text"))


@query("dedupe_keep_last")
def q_dedupe_keep_last(spark, sf_dir):
    return parsed_split(spark, sf_dir)


@query("labelled_split")
def q_labelled_split(spark, sf_dir):
    j = ingest.labelled_split(parsed_split(spark, sf_dir), parsed_corpus(spark, sf_dir))
    return j.withColumn("article_id", F.col("article_id").cast("double"))


@query("missing_after_join")
def q_missing_after_join(spark, sf_dir):
    split = parsed_split(spark, sf_dir).withColumn("split", F.expr(fx.SPLIT.replace("doc_id", "record_id")))
    return ingest.check_missing(ingest.labelled_split(split, parsed_corpus(spark, sf_dir)))


@query("union_splits")
def q_union_splits(spark, sf_dir):
    s = fx.split_labels(spark, sf_dir).drop("split")
    c = fx.corpus(spark, sf_dir)
    train = ingest.labelled_split(s.filter("record_id % 10 < 8"), c)
    dev = ingest.labelled_split(s.filter("record_id % 10 = 8"), c)
    return ingest.union_splits(train=train, dev=dev).select("record_id", "binary_label", "split", "text")


# ---------------------------------------------------------------------------
# A1-A7
# ---------------------------------------------------------------------------
@query("split_summary")
def q_split_summary(spark, sf_dir):
    return profile.split_summary(eda_frame(spark, sf_dir)).withColumn("positive_rate", R("positive_rate"))


@query("class_counts")
def q_class_counts(spark, sf_dir):
    return profile.class_counts(eda_frame(spark, sf_dir))


@query("class_distribution")
def q_class_distribution(spark, sf_dir):
    return profile.class_pivot(eda_frame(spark, sf_dir))


@query("token_p99")
def q_token_p99(spark, sf_dir):
    return profile.token_quantile(eda_frame(spark, sf_dir), 0.99).withColumn("p99", R("p99"))


@query("top_repeated_texts")
def q_top_repeated_texts(spark, sf_dir):
    return profile.top_repeated_texts(eda_frame(spark, sf_dir), 20)


@query("kde_token_count")
def q_kde_token_count(spark, sf_dir):
    k = profile.grouped_kde(eda_frame(spark, sf_dir), "token_count", "binary_label")
    return k.withColumns({"x": R("x"), "density": R("density", 12)})


@query("kde_score")
def q_kde_score(spark, sf_dir):
    from ..functions.scores import outcome_group
    df = scored(spark, sf_dir).withColumn("group", outcome_group())
    k = profile.grouped_kde(df, "score", "group")
    return k.withColumns({"x": R("x"), "density": R("density", 9)})


# ---------------------------------------------------------------------------
# Evaluation on the exact fixture score: P5, F10-F13, A8-A16, W2-W4, M4, M5
# ---------------------------------------------------------------------------
SCORED_COLS = ["record_id", "y_true", "y_pred", "score"]


@query("false_positives")
def q_false_positives(spark, sf_dir):
    from ..operators.evaluate import mistakes
    return mistakes(scored(spark, sf_dir), "fp").select(*SCORED_COLS)


@query("false_negatives")
def q_false_negatives(spark, sf_dir):
    from ..operators.evaluate import mistakes
    return mistakes(scored(spark, sf_dir), "fn").select(*SCORED_COLS)


@query("softmax_prob")
def q_softmax_prob(spark, sf_dir):
    from ..functions.scores import softmax2
    return scored(spark, sf_dir).select("record_id", R(softmax2("l0", "l1"), 12).alias("prob_pos"))


@query("apply_threshold")
def q_apply_threshold(spark, sf_dir):
    from ..functions.scores import apply_threshold
    return scored(spark, sf_dir).select("record_id", apply_threshold("score", 0.5).alias("y_pred"))


@query("mistake_strength")
def q_mistake_strength(spark, sf_dir):
    from ..functions.scores import mistake_strength
    df = scored(spark, sf_dir).filter("y_true <> y_pred")
    return df.select("record_id", "y_true", "y_pred", mistake_strength("score").alias("mistake_strength"))


@query("outcome_groups")
def q_outcome_groups(spark, sf_dir):
    from ..functions.scores import outcome_group
    df = scored(spark, sf_dir).withColumn("group", outcome_group())
    return df.groupBy("group").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


@query("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    from ..operators.evaluate import confusion_counts
    return confusion_counts(scored(spark, sf_dir))


@query("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    from ..operators.evaluate import binary_metrics
    return binary_metrics(scored(spark, sf_dir))


@query("classification_report")
def q_classification_report(spark, sf_dir):
    from ..operators.evaluate import classification_report
    return classification_report(scored(spark, sf_dir))


@query("metrics_at_half")
def q_metrics_at_half(spark, sf_dir):
    from ..functions.scores import softmax2
    from ..operators.evaluate import metrics_at
    return metrics_at(scored(spark, sf_dir).withColumn("prob_pos", softmax2("l0", "l1")), 0.5)


@query("pred_positive_rate")
def q_pred_positive_rate(spark, sf_dir):
    from ..operators.evaluate import pred_positive_rate
    return pred_positive_rate(scored(spark, sf_dir)).withColumn("positive_rate_pred", R("positive_rate_pred"))


@query("class_weights")
def q_class_weights(spark, sf_dir):
    from ..operators.linear import class_weights
    return class_weights(scored(spark, sf_dir).filter("split = 'train'"), "y_true")


@query("weighted_log_loss")
def q_weighted_log_loss(spark, sf_dir):
    from ..operators.evaluate import weighted_log_loss
    from ..operators.linear import class_weights
    df = scored(spark, sf_dir)
    w = class_weights(df.filter("split = 'train'"), "y_true")
    return weighted_log_loss(df, w).select(R("loss").alias("loss"), R("weight_sum").alias("weight_sum"))


@query("local_evaluation")
def q_local_evaluation(spark, sf_dir):
    from ..operators.evaluate import local_evaluation
    return local_evaluation(scored(spark, sf_dir))


@query("category_recall")
def q_category_recall(spark, sf_dir):
    from ..operators.evaluate import category_recall
    return category_recall(scored(spark, sf_dir)).withColumn("recall", R("recall"))


def _top(spark, sf_dir, kind):
    from ..operators.evaluate import top_mistakes
    t = top_mistakes(scored(spark, sf_dir, with_text=True), kind)
    return t.select("record_id", "y_true", "y_pred", "score", "mistake_strength", "text")


@query("top_false_positives")
def q_top_false_positives(spark, sf_dir):
    return _top(spark, sf_dir, "fp")


@query("top_false_negatives")
def q_top_false_negatives(spark, sf_dir):
    return _top(spark, sf_dir, "fn")


@query("threshold_adaptive")
def q_threshold_adaptive(spark, sf_dir):
    from ..operators.threshold import best_threshold_adaptive
    return best_threshold_adaptive(scored(spark, sf_dir), "score")


@query("threshold_fixed")
def q_threshold_fixed(spark, sf_dir):
    from ..functions.scores import softmax2
    from ..operators.threshold import best_threshold_fixed
    df = scored(spark, sf_dir).withColumn("prob_pos", softmax2("l0", "l1"))
    return best_threshold_fixed(df, "prob_pos").withColumn("f1", R("f1", 12))


# Candidate scorers of the fixture for the leaderboard, in model order.
LEADERBOARD_CANDIDATES = [
    ("score", "score"),
    ("prob", None),
    ("inverse", "1 - score"),
]


@query("leaderboard")
def q_leaderboard(spark, sf_dir):
    from ..functions.scores import softmax2
    from ..operators.evaluate import leaderboard
    from ..operators.threshold import best_threshold_adaptive
    df = scored(spark, sf_dir)
    rows = []
    for pos, (name, expr) in enumerate(LEADERBOARD_CANDIDATES):
        s = softmax2("l0", "l1") if expr is None else F.expr(expr)
        best = best_threshold_adaptive(df.withColumn("_s", s), "_s").first()
        rows.append((name, pos, float(best["f1"]), float(best["threshold"])))
    cands = spark.createDataFrame(rows, "model string, position int, f1 double, threshold double")
    return leaderboard(cands).withColumn("threshold", R("threshold", 12))


@query("best_checkpoint")
def q_best_checkpoint(spark, sf_dir):
    from ..functions.scores import apply_threshold, softmax2
    from ..operators.evaluate import best_checkpoint, binary_metrics
    df = scored(spark, sf_dir).withColumns({
        "step": (F.col("record_id") % 10).cast("int"),
        "_pred": apply_threshold(softmax2("l0", "l1"), 0.5),
    })
    hist = binary_metrics(df, "y_true", "_pred", by=["step"]).select(
        "step", F.col("f1").alias("f1_pos"), F.col("precision").alias("precision_pos"),
        F.col("recall").alias("recall_pos"),
    )
    return best_checkpoint(hist, "f1_pos", "step")


# ---------------------------------------------------------------------------
# TF-IDF on the labelled train split, transform of dev + test
# ---------------------------------------------------------------------------
# A coefficient rule and bias that give a model without training,
# so the decision score (M3) and the model round trip (K5) have an SQL oracle.
FIXED_COEF = "cast(((length(term) * 7) % 11 - 5) as double) / cast(10 as double)"
FIXED_BIAS = -0.25


def train_docs(spark, sf_dir):
    s = fx.split_labels(spark, sf_dir)
    return ingest.labelled_split(s.filter("split = 'train'"), fx.corpus(spark, sf_dir))


def dev_docs(spark, sf_dir):
    s = fx.split_labels(spark, sf_dir)
    return ingest.labelled_split(s.filter("split = 'dev'"), fx.corpus(spark, sf_dir))


def dev_test_docs(spark, sf_dir):
    dev = dev_docs(spark, sf_dir).select("record_id", "text")
    return dev.unionByName(fx.test_docs(spark, sf_dir).select("record_id", "text"))


@query("normalize_text")
def q_normalize_text(spark, sf_dir):
    (docs,) = fx.tables(spark, sf_dir, "documents")
    return docs.select("doc_id", T.normalize_text(T.clean_text("text")).alias("text"))


@query("word_tokens")
def q_word_tokens(spark, sf_dir):
    (docs,) = fx.tables(spark, sf_dir, "documents")
    tok = T.word_tokens(T.normalize_text(T.clean_text("text")))
    # joined with '|' (never a word character) so both engines compare one string
    return docs.select("doc_id", F.size(tok).alias("n_tokens"), F.array_join(tok, "|").alias("tokens"))


@query("ngrams")
def q_ngrams(spark, sf_dir):
    (docs,) = fx.tables(spark, sf_dir, "documents")
    terms = T.ngrams_1_2(T.word_tokens(T.normalize_text(T.clean_text("text"))))
    return docs.select("doc_id", F.size(terms).alias("n_terms"), F.array_join(terms, "|").alias("terms"))


@query("vocabulary")
def q_vocabulary(spark, sf_dir):
    from ..operators import tfidf
    return tfidf.fit_vocabulary(train_docs(spark, sf_dir)).table.select("term", "idx", "df")


@query("sublinear_tf")
def q_sublinear_tf(spark, sf_dir):
    from ..operators import tfidf
    tc = tfidf.term_counts(train_docs(spark, sf_dir), carry=["record_id"])
    return tc.select("record_id", "term", "tf", R(tfidf.sublinear_tf("tf")).alias("sublinear_tf"))


@query("idf")
def q_idf(spark, sf_dir):
    from ..operators import tfidf
    v = tfidf.fit_vocabulary(train_docs(spark, sf_dir))
    return v.table.select("term", R("idf").alias("idf"))


@query("tfidf")
def q_tfidf(spark, sf_dir):
    from ..operators import tfidf
    tr = train_docs(spark, sf_dir)
    v = tfidf.fit_vocabulary(tr)
    long = tfidf.to_long(tfidf.transform(tr, v, carry=["record_id"], keep_terms=True), ["record_id"])
    return long.select("record_id", "term", R("weight").alias("weight"))


@query("tfidf_transform")
def q_tfidf_transform(spark, sf_dir):
    from ..operators import tfidf
    v = tfidf.fit_vocabulary(train_docs(spark, sf_dir))
    long = tfidf.to_long(tfidf.transform(dev_test_docs(spark, sf_dir), v, carry=["record_id"], keep_terms=True), ["record_id"])
    return long.select("record_id", "term", R("weight").alias("weight"))


def fixed_model(spark, sf_dir):
    """A model with rule-given coefficients on the fitted train vocabulary."""
    from ..operators import tfidf
    from .pipeline import LinearModel
    v = tfidf.fit_vocabulary(train_docs(spark, sf_dir))
    coef = v.table.select("idx", F.expr(FIXED_COEF).alias("coef"))
    return LinearModel("fixed", v, coef, FIXED_BIAS, 0.0, {})


@query("decision_score")
def q_decision_score(spark, sf_dir):
    m = fixed_model(spark, sf_dir)
    return m.decision(dev_test_docs(spark, sf_dir), carry=["record_id"]).select("record_id", R("score").alias("score"))


# ---------------------------------------------------------------------------
# M1, M2, M6, M7: training (no SQL oracle: iterative optimisation)
# ---------------------------------------------------------------------------
def _fit_one(spark, sf_dir, loss, C, name):
    """A certificate of the fit: its size, and whether a gradient computed by joins alone is below 1e-6."""
    from ..operators import tfidf
    from ..operators.linear import class_weights, gradient_norm, training_rows
    from ..operators.solver import fit_linear
    from ..session import checkpoint_root
    checkpoint_root(spark)
    tr = tfidf.worded(train_docs(spark, sf_dir), carry=["binary_label"]).checkpoint()
    v = tfidf.fit_vocabulary(tr)
    rows = training_rows(tfidf.transform(tr, v, carry=["binary_label"]), class_weights(tr, "binary_label"), "binary_label")
    coef, b, info = fit_linear(rows, loss, C)
    certificate = gradient_norm(rows, coef, b, loss, C)
    return certificate.select(
        F.lit(name).alias("model"), F.lit(v.size).cast("bigint").alias("n_features"), F.lit(info["n_rows"]).cast("bigint").alias("n_rows"),
        (F.col("grad_norm") < 1e-6).alias("optimal"),
    )


@query("logreg_fit")
def q_logreg_fit(spark, sf_dir):
    from ..operators.linear import LOGREG_C
    return _fit_one(spark, sf_dir, "logistic", LOGREG_C, "logreg")


@query("linearsvc_fit")
def q_linearsvc_fit(spark, sf_dir):
    from ..operators.linear import SVM_C
    return _fit_one(spark, sf_dir, "squared_hinge", SVM_C, "linearsvc")


@query("model_selection")
def q_model_selection(spark, sf_dir):
    from .pipeline import select_model
    _, board, _ = select_model(train_docs(spark, sf_dir), dev_docs(spark, sf_dir))
    return board


@query("score_test")
def q_score_test(spark, sf_dir):
    from .pipeline import score_split, select_model
    best, _, _ = select_model(train_docs(spark, sf_dir), dev_docs(spark, sf_dir))
    return score_split(best, fx.test_docs(spark, sf_dir), carry=["record_id"]).select("record_id", "score", "y_pred")


# ---------------------------------------------------------------------------
# Write the derived fixture with Spark, read it back
# ---------------------------------------------------------------------------
def _tsv_fixture(df: DataFrame, path: str, columns, breaks: bool = False) -> None:
    """Fixture writer: tab-separated, quoted where needed, line breaks in text -> space unless kept."""
    cols = [F.regexp_replace(F.col(c), r"[\r\n]", " ").alias(c) if c == "text" and not breaks else F.col(c) for c in columns]
    (df.orderBy("_ord").select(*cols).write.mode("overwrite")
     .option("sep", "\t").option("quote", '"').option("escape", '"').option("header", False)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


# Malformed lines appended to the corpus file: a disclaimer, a line with too
# many fields and a line with too few; none of them survives ingestion.
MALFORMED_CORPUS_LINES = [
    "disclaimer line",
    "1000000001\t@@7\tkw\tus\ttoo\tmany\t2\textra",
    "1000000002\t@@8\tkw\tus",
]


@query("read_corpus_tsv")
def q_read_corpus_tsv(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import CORPUS_COLUMNS, read_corpus
    path = scratch_path(spark, "corpus")
    _tsv_fixture(fx.raw_corpus(spark, sf_dir), f"{path}/main", CORPUS_COLUMNS)
    spark.createDataFrame([(x,) for x in MALFORMED_CORPUS_LINES], "value string").write.mode(
        "overwrite").text(f"{path}/malformed")
    raw = read_corpus(spark, [f"{path}/main", f"{path}/malformed"])
    return ingest.parse_corpus(raw).drop("_ord")


@query("read_corpus_breaks")
def q_read_corpus_breaks(spark, sf_dir):
    """The corpus file with the line breaks of its texts, read in splits."""
    from ..session import scratch_path
    from ..sources.readers import CORPUS_COLUMNS, read_corpus
    path = scratch_path(spark, "corpus-breaks")
    _tsv_fixture(fx.raw_corpus(spark, sf_dir), f"{path}/main", CORPUS_COLUMNS, breaks=True)
    spark.createDataFrame([(x,) for x in MALFORMED_CORPUS_LINES], "value string").write.text(f"{path}/malformed")
    return ingest.parse_corpus(read_corpus(spark, [f"{path}/main", f"{path}/malformed"], multi_line=True)).drop("_ord")


@query("read_split_csv")
def q_read_split_csv(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import read_split
    path = scratch_path(spark, "split")
    (fx.raw_split(spark, sf_dir).orderBy("_ord").select("par_id", "label").write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"').csv(path))
    return ingest.parse_split(read_split(spark, path)).drop("_ord")


@query("read_test_tsv")
def q_read_test_tsv(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import TEST_COLUMNS, read_test
    path = scratch_path(spark, "test")
    _tsv_fixture(fx.raw_test(spark, sf_dir), path, TEST_COLUMNS)
    return ingest.parse_test(read_test(spark, path)).drop("_ord")


@query("read_scored")
def q_read_scored(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import read_scored
    from ..sources.sinks import write_scored
    path = scratch_path(spark, "scored")
    write_scored(scored(spark, sf_dir, with_text=True).select(*SCORED_COLS, "text"), path)
    return read_scored(spark, path)


def _delivered(spark, sf_dir):
    """Where a deliverable of the fixed model, whose scores SQL can state, stands."""
    from ..session import scratch_path
    from ..sources.delivery import delivered
    from .pipeline import deliver
    path = scratch_path(spark, "deliverables")
    dev = dev_docs(spark, sf_dir).drop("split")
    deliver(fixed_model(spark, sf_dir), None, dev, fx.test_docs(spark, sf_dir), path, "record_id")
    return lambda name: delivered(spark, path, name)


DEV_DETAIL = ["record_id", "binary_label", "label_raw", "article_id", "keyword", "country", "text", "y_true", "y_pred"]


@query("scored_dev")
def q_scored_dev(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.readers import read_scored
    from ..sources.sinks import write_scored
    from .pipeline import detail
    path = scratch_path(spark, "scored-dev")
    write_scored(detail(fixed_model(spark, sf_dir), dev_docs(spark, sf_dir).drop("split"), label="binary_label"), path, fmt="csv")
    back = read_scored(spark, path, fmt="csv").withColumn("text", F.coalesce("text", F.lit("")))
    return back.select(*DEV_DETAIL, R("score").alias("score"))


@query("scored_test")
def q_scored_test(spark, sf_dir):
    back = spark.read.parquet(_delivered(spark, sf_dir)("test_detail"))
    return back.select("record_id", "article_id", "keyword", "country", "text", R("score").alias("score"), "y_pred")


@query("dev_report")
def q_dev_report(spark, sf_dir):
    return spark.read.parquet(_delivered(spark, sf_dir)("dev_report"))


@query("error_analysis")
def q_error_analysis(spark, sf_dir):
    path = _delivered(spark, sf_dir)
    both = [spark.read.parquet(path(name)).withColumn("kind", F.lit(name)) for name in ("false_positives", "false_negatives")]
    return both[0].unionByName(both[1]).select("kind", *DEV_DETAIL, R("score").alias("score"), R("mistake_strength").alias("mistake_strength"))


@query("deliverables")
def q_deliverables(spark, sf_dir):
    """Lines and positives of both prediction files, against the rates that the saved model's metadata holds."""
    from ..sources.sinks import load_model
    path = _delivered(spark, sf_dir)
    meta = load_model(spark, path("model")).meta
    out = None
    for name in ("dev", "test"):
        lines = spark.read.text(path(f"{name}_lines")).select(F.col("value").cast("double").alias("v"))
        one = lines.agg(F.count("v").alias("lines"), R(F.avg("v")).alias("positive_rate")).select(
            F.lit(name).alias("split"), "lines", "positive_rate",
            (F.abs(F.col("positive_rate") - F.lit(float(meta[f"{name}_positive_rate"]))) < 1e-8).alias("as_in_metadata"))
        out = one if out is None else out.unionByName(one)
    return out


@query("run_files")
def q_run_files(spark, sf_dir):
    """A whole run from written input files to its deliverables: lines of both prediction files, and whether the
    manifest, the metadata and the details agree with them."""
    from ..operators.evaluate import binary_metrics
    from ..session import scratch_path
    from ..sources.delivery import delivered, manifest
    from ..sources.readers import CORPUS_COLUMNS, TEST_COLUMNS
    from .pipeline import run_files
    path = scratch_path(spark, "run")
    corpus = fx.raw_corpus(spark, sf_dir).withColumns({
        "record_id": F.col("doc_id").cast("string"), "article_id": F.concat(F.lit("@@"), F.col("doc_id")), "raw_label": F.lit("1")})
    _tsv_fixture(corpus, f"{path}/corpus", CORPUS_COLUMNS, breaks=True)
    _tsv_fixture(fx.raw_test(spark, sf_dir), f"{path}/test", TEST_COLUMNS, breaks=True)
    for name in ("train", "dev"):
        rows = fx.split_labels(spark, sf_dir).filter(F.col("split") == name)
        rows = rows.select(F.col("record_id").cast("string").alias("par_id"), F.col("binary_label").cast("string").alias("label"))
        rows.write.option("header", True).csv(f"{path}/{name}")
    out = f"{path}/out"
    meta = run_files(spark, f"{path}/corpus", f"{path}/train", f"{path}/dev", f"{path}/test", out, multi_line=True)
    told = manifest(spark, out)
    detail = spark.read.parquet(delivered(spark, out, "dev_detail"))
    f1 = binary_metrics(detail, "y_true", "y_pred").first()["f1"]
    parts = []
    for name in ("dev", "test"):
        lines = spark.read.text(delivered(spark, out, f"{name}_lines")).select(F.col("value").cast("double").alias("v"))
        parts.append(lines.agg(F.count("v").alias("lines"), F.avg("v").alias("rate")).select(
            F.lit(name).alias("split"), "lines",
            (F.col("lines") == F.lit(told["tables"][f"{name}_lines"]["rows"])).alias("in_manifest"),
            (F.abs(F.col("rate") - F.lit(float(meta[f"{name}_positive_rate"]))) < 1e-12).alias("rate_confirmed"),
            F.lit(bool(abs(f1 - meta["dev_f1"]) < 1e-12 and told["meta"]["dev_f1"] == meta["dev_f1"])).alias("f1_confirmed")))
    return parts[0].unionByName(parts[1])


@query("profile_tables")
def q_profile_tables(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.sinks import write_tables
    path = scratch_path(spark, "profile")
    eda = eda_frame(spark, sf_dir)
    write_tables({"class_distribution": profile.class_pivot(eda), "token_stats": profile.token_stats(eda)}, path)
    return spark.read.parquet(f"{path}/class_distribution")


def repeated_docs(spark, sf_dir):
    """Training rows with duplicated ids: every fifth id comes a second time with other text, every seventh as an exact copy."""
    tr = train_docs(spark, sf_dir).select("record_id", "text")
    other = tr.filter("record_id % 5 = 0").withColumn("text", F.concat("text", F.lit(" second copy of a row")))
    return tr.unionByName(other).unionByName(tr.filter("record_id % 7 = 0"))


@query("vocabulary_repeated_ids")
def q_vocabulary_repeated_ids(spark, sf_dir):
    from ..operators import tfidf
    return tfidf.fit_vocabulary(repeated_docs(spark, sf_dir)).table.select("term", "df", R("idf").alias("idf"))


@query("decision_repeated_ids")
def q_decision_repeated_ids(spark, sf_dir):
    from ..operators import tfidf
    from .pipeline import LinearModel
    docs = repeated_docs(spark, sf_dir)
    v = tfidf.fit_vocabulary(docs)
    m = LinearModel("fixed", v, v.table.select("idx", F.expr(FIXED_COEF).alias("coef")), FIXED_BIAS, 0.0, {})
    return m.decision(docs, carry=["record_id"]).select("record_id", R("score").alias("score"))


@query("model_selection_certificate")
def q_model_selection_certificate(spark, sf_dir):
    """Per candidate: its fit is optimal by a gradient computed by joins alone, its F1 is that of its
    predictions counted anew, and the leaderboard's first is the one chosen."""
    from ..operators import tfidf
    from ..operators.evaluate import binary_metrics
    from ..operators.linear import class_weights, gradient_norm, training_rows
    from .pipeline import CANDIDATES, score_split, select_model
    tr, dev = train_docs(spark, sf_dir), dev_docs(spark, sf_dir)
    best, board, models = select_model(tr, dev)
    first = board.orderBy("rank").first()["model"]
    rows = training_rows(tfidf.transform(tr, best.vocab, carry=["binary_label"]), class_weights(tr, "binary_label"))
    out = None
    for position, (name, loss, C) in enumerate(CANDIDATES):
        m = models[name]
        counted = binary_metrics(score_split(m, dev, carry=["binary_label"]), "binary_label", "y_pred")
        one = gradient_norm(rows, m.coef, m.bias, loss, C).crossJoin(F.broadcast(counted)).select(
            F.lit(name).alias("model"), F.lit(position).alias("position"),
            (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).cast("bigint").alias("n_dev"),
            (F.col("grad_norm") < 1e-6).alias("optimal"),
            (F.abs(F.col("f1") - F.lit(m.meta["dev_f1"])) < 1e-12).alias("f1_confirmed"),
            F.lit(best.name == first and best.meta["dev_f1"] >= m.meta["dev_f1"]).alias("best_chosen"))
        out = one if out is None else out.unionByName(one)
    return out


@query("training_history_certificate")
def q_training_history_certificate(spark, sf_dir):
    """Per iteration of the solver: its dev F1 counted anew from joined terms and coefficients, and whether it is the step restored."""
    from ..functions import text as tx
    from ..operators.evaluate import binary_metrics
    from .pipeline import fit_by_steps, score_split
    dev = dev_docs(spark, sf_dir)
    best, history = fit_by_steps(train_docs(spark, sf_dir), dev)
    table = best.vocab.table.join(best.coef, "idx", "left").select("term", "idf", F.coalesce("coef", F.lit(0.0)).alias("coef"))
    tf = dev.select("record_id", F.explode(tx.analyzed_terms("text")).alias("term")).groupBy("record_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    w = tf.join(table, "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    sums = w.groupBy("record_id").agg((F.sum(F.col("w") * F.col("coef")) / F.sqrt(F.sum(F.col("w") * F.col("w")))).alias("s"))
    again = dev.join(sums, "record_id", "left").withColumn("p", (F.coalesce("s", F.lit(0.0)) + F.lit(best.bias) >= 0).cast("int"))
    anew = binary_metrics(again, "binary_label", "p").first()
    restored = binary_metrics(score_split(best, dev, carry=["binary_label"]), "binary_label", "y_pred").first()
    top = history.agg(F.max("f1_pos").alias("top"), F.min(F.when(F.col("step") > 0, F.col("objective"))).alias("low"), F.count(F.lit(1)).alias("n")).first()
    earliest = history.filter(F.col("f1_pos") == F.lit(top["top"])).agg(F.min("step")).first()[0]
    rising = history.orderBy("step").select("objective").toPandas()["objective"]
    return dev.agg(F.count(F.lit(1)).alias("n_dev")).select(
        F.lit(best.name).alias("model"), "n_dev",
        F.lit(bool(top["n"] == best.meta["steps"] > 2)).alias("every_step_scored"),
        F.lit(bool(all(b <= a + 1e-9 * abs(a) for a, b in zip(rising, rising[1:])))).alias("objective_falls"),
        F.lit(bool(earliest == best.meta["step"])).alias("earliest_best_chosen"),
        F.lit(bool(max(abs(x["f1"] - top["top"]) for x in (anew, restored)) < 1e-12)).alias("f1_confirmed"))


@query("score_test_certificate")
def q_score_test_certificate(spark, sf_dir):
    """Per test row: its score equals a sum over exploded terms joined to the saved model's table."""
    from ..functions import text as tx
    from ..session import scratch_path
    from ..sources.sinks import save_model
    from .pipeline import score_split, select_model
    best, _, _ = select_model(train_docs(spark, sf_dir), dev_docs(spark, sf_dir))
    test = fx.test_docs(spark, sf_dir)
    path = scratch_path(spark, "model")
    save_model(best, path)
    terms = test.select("record_id", F.explode(tx.analyzed_terms("text")).alias("term")).groupBy("record_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    w = terms.join(spark.read.parquet(f"{path}/terms"), "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    sums = w.groupBy("record_id").agg((F.sum(F.col("w") * F.col("coef")) / F.sqrt(F.sum(F.col("w") * F.col("w")))).alias("s"))
    scored_rows = score_split(best, test, carry=["record_id"]).join(sums, "record_id", "left")
    apart = F.abs(F.col("score") - F.coalesce("s", F.lit(0.0)) - F.lit(best.bias))
    return scored_rows.select("record_id", (apart < 1e-9).alias("score_confirmed"),
                              (F.col("y_pred") == (F.col("score") >= best.threshold).cast("int")).alias("prediction_confirmed"))


@query("prediction_lines")
def q_prediction_lines(spark, sf_dir):
    from ..operators.ordering import number_by_position
    from ..session import scratch_path
    from ..sources.sinks import read_lines, write_lines
    path = scratch_path(spark, "lines")
    write_lines(scored(spark, sf_dir), path, "y_pred", "record_id")
    back = number_by_position(read_lines(spark, path), "_ord", "line")
    return back.select("line", F.col("value").cast("int").alias("y_pred"))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.sinks import load_model, save_model
    path = scratch_path(spark, "model")
    save_model(fixed_model(spark, sf_dir), path)
    m = load_model(spark, path)
    return m.decision(dev_test_docs(spark, sf_dir), carry=["record_id"]).select("record_id", R("score").alias("score"))
