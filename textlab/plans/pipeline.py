"""End-to-end pipelines: model selection (M6) and batch scoring (M7)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scores import apply_threshold
from ..operators import tfidf
from ..session import checkpoint_root, observed_write, stored
from ..operators.evaluate import best_checkpoint, leaderboard, step_metrics
from ..operators.linear import COEF_BROADCAST_MAX, LOGREG_C, SVM_C, class_weights, decision_score, decision_scores, training_rows
from ..operators.solver import SOLVER_TOL, fit_linear, fit_linears
from ..operators.threshold import best_threshold_adaptive

# The candidate models, in the reference's order.
CANDIDATES = [("logreg", "logistic", LOGREG_C), ("linearsvc", "squared_hinge", SVM_C)]


@dataclass
class LinearModel:
    name: str
    vocab: tfidf.Vocabulary
    coef: DataFrame  # (idx, coef)
    bias: float
    threshold: float
    meta: dict = field(default_factory=dict)

    def decision(self, docs: DataFrame, text: str = "text", carry=()) -> DataFrame:
        """(*carry, score): the linear decision value of each row (M3)."""
        if not self.vocab.small():
            coefs = self.coef.select("idx", F.array("coef").alias("coefs"))
            return tfidf.decisions(docs, self.vocab, coefs, [self.bias], text, carry).select(*carry, F.col("scores")[0].alias("score"))
        packed = tfidf.transform(docs, self.vocab, text, carry)
        return decision_score(packed, self.coef, self.bias, carry, size=self.vocab.size)


def _scores(docs: DataFrame, vocab: tfidf.Vocabulary, coefs: DataFrame, biases: list[float], text: str, carry) -> DataFrame:
    """(*carry, scores array) of several models: inside the row where vocabulary and coefficients are broadcast, else by the terms of chunks."""
    if vocab.small() and vocab.size * len(biases) <= COEF_BROADCAST_MAX:
        return decision_scores(tfidf.transform(docs, vocab, text, carry), coefs, biases, carry)
    return tfidf.decisions(docs, vocab, coefs, biases, text, carry)


def select_model(train: DataFrame, dev: DataFrame, text: str = "text", label: str = "binary_label",
                 tol: float = SOLVER_TOL, candidates=CANDIDATES):
    """Fit every candidate on train, tune its threshold on dev, keep the best (M6).

    Features are computed once and shared by the candidates, which are fitted
    side by side in the same passes.  The chosen threshold and the reported F1
    both come from dev, as in the reference.
    Returns (best LinearModel, leaderboard DataFrame, {name: LinearModel}).
    """
    spark = train.sparkSession
    checkpoint_root(spark)
    train = tfidf.worded(train, text, [label]).checkpoint()  # the words are found once, for the vocabulary and the rows
    vocab = tfidf.fit_vocabulary(train, text)
    weights = class_weights(train, label)
    rows = training_rows(tfidf.transform(train, vocab, text, carry=[label]), weights, label)
    by_label = {r["label"]: r["weight"] for r in weights.collect()}
    fits = fit_linears(rows, [(loss, C) for _, loss, C in candidates], tol)
    scored = _scores(dev, vocab, fits[0][2].pop("coefs"), [b for _, b, _ in fits], text, [label]).checkpoint()
    models, board = {}, []
    for pos, ((name, loss, C), (coef, b, info)) in enumerate(zip(candidates, fits)):
        scores = scored.select(label, F.col("scores")[pos].alias("score"))
        best = best_threshold_adaptive(scores.withColumnRenamed(label, "y_true"), "score").first()
        meta = {k: v for k, v in info.items() if k not in ("history", "coefs")}
        meta.update({"loss": loss, "C": C, "dev_f1": float(best["f1"]), "class_weights": [by_label[0], by_label[1]]})
        models[name] = LinearModel(name, vocab, coef, b, float(best["threshold"]), meta)
        models[name].meta["history"] = info["history"]
        board.append((name, pos, float(best["f1"]), float(best["threshold"])))
    board_df = leaderboard(spark.createDataFrame(board, "model string, position int, f1 double, threshold double"))
    # strictly greater wins, so ties keep the earlier candidate
    best_name = max(board, key=lambda r: (r[2], -r[1]))[0]
    return models[best_name], board_df, models


def fit_by_steps(train: DataFrame, dev: DataFrame, candidate=CANDIDATES[0], text: str = "text", label: str = "binary_label",
                 tol: float = SOLVER_TOL, max_iter: int = 1000):
    """Fit one candidate, score dev after every iteration of the solver and restore the best step.

    The solver starts at zero; its iterates are scored together, in one pass
    over dev.  A row of the history is one iteration: F1, precision and recall of the
    positive class at a decision value of zero, objective and gradient norm.
    Returns (LinearModel of the best step, the earliest on ties; history).
    """
    spark = train.sparkSession
    name, loss, C = candidate
    checkpoint_root(spark)
    train = tfidf.worded(train, text, [label]).checkpoint()  # the words are found once, for the vocabulary and the rows
    vocab = tfidf.fit_vocabulary(train, text)
    rows = training_rows(tfidf.transform(train, vocab, text, carry=[label]), class_weights(train, label), label)
    _, _, info = fit_linear(rows, loss, C, tol, max_iter, start=False, keep_steps=True)
    coefs, biases = info["steps"]
    scores = _scores(dev, vocab, coefs, biases, text, [label])
    seen = spark.createDataFrame([(i, float(f), float(g)) for i, f, g in info["history"]], "step int, objective double, grad_norm double")
    history = step_metrics(scores, label).join(F.broadcast(seen), "step").checkpoint()
    best = best_checkpoint(history).first()
    coef = coefs.select("idx", F.col("coefs")[best["step"]].alias("coef"))
    meta = {"loss": loss, "C": C, "dev_f1": float(best["f1_pos"]), "step": int(best["step"]), "steps": len(biases), "n_rows": info["n_rows"]}
    return LinearModel(name, vocab, coef, biases[best["step"]], 0.0, meta), history


def score_split(model: LinearModel, docs: DataFrame, text: str = "text", carry=()) -> DataFrame:
    """Decision score and 0/1 prediction at the tuned threshold, one row per input row (M7)."""
    s = model.decision(docs, text, carry)
    return s.withColumn("y_pred", apply_threshold("score", model.threshold))


def detail(model: LinearModel, docs: DataFrame, text: str = "text", label: str | None = None) -> DataFrame:
    """All columns of ``docs``, then y_true (of a labelled split), score and y_pred (K2)."""
    scored = score_split(model, docs, text, docs.columns)
    if label:
        scored = scored.withColumn("y_true", F.col(label))
    return scored.select(*docs.columns, *(["y_true"] if label else []), "score", "y_pred")


def deliver(model: LinearModel, board: DataFrame | None, dev: DataFrame, test: DataFrame, folder: str, order: str,
            test_order: str | None = None, text: str = "text", label: str = "binary_label") -> dict:
    """Score dev and test with the chosen model and write everything a run hands over (M7, K1-K5).

    Details, prediction lines in input order, report, summary row, mistakes,
    score density, leaderboard, model; returns the run's metadata, which the
    model's folder and the manifest hold as well.  The details are written first
    and read back for all that follows, so each split is scored once, and the
    rates of positive predictions are observed in that write.  All of it
    becomes visible at once, by the manifest (``delivery.delivered``).
    """
    from ..functions.scores import outcome_group
    from ..operators.evaluate import classification_report, local_evaluation, top_mistakes
    from ..operators.profile import grouped_kde
    from ..sources.delivery import Delivery
    from ..sources.readers import read_scored
    from ..sources.sinks import save_model, write_lines, write_scored

    spark = dev.sparkSession
    run = Delivery(spark, folder)
    rate = F.avg(F.col("y_pred").cast("double"))
    dev_seen = observed_write(detail(model, dev, text, label), run.path("dev_detail"), rate=rate)
    test_seen = observed_write(detail(model, test, text), run.path("test_detail"), rate=rate)
    if not test_seen["rows"]:
        raise ValueError("test: no valid record is left after parsing")
    run.path("dev_detail", rows=dev_seen["rows"])
    run.path("test_detail", rows=test_seen["rows"])
    dev_d, test_d = read_scored(spark, run.path("dev_detail")), spark.read.parquet(run.path("test_detail"))
    write_lines(dev_d, run.path("dev_lines", rows=dev_seen["rows"]), "y_pred", order)
    write_lines(test_d, run.path("test_lines", rows=test_seen["rows"]), "y_pred", test_order or order)
    tables = {
        "dev_report": classification_report(dev_d),
        "local_evaluation": local_evaluation(dev_d),
        "false_positives": top_mistakes(dev_d, "fp"),
        "false_negatives": top_mistakes(dev_d, "fn"),
        "score_density": grouped_kde(dev_d.withColumn("group", outcome_group("y_true", "y_pred")), "score", "group"),
    }
    for name, table in (tables | ({"leaderboard": board} if board is not None else {})).items():
        write_scored(table, run.path(name))
    model.meta.update({"dev_positive_rate": dev_seen["rate"], "test_positive_rate": test_seen["rate"]})
    model.meta.pop("history", None)
    save_model(model, run.path("model"))
    run.commit(meta=model.meta)
    return dict(model.meta)


def run_files(spark: SparkSession, corpus_path, train_path: str, dev_path: str, test_path, folder: str, multi_line: bool = False) -> dict:
    """From the four input files to all deliverables: read, parse, join, check, select, score, write.

    Empty inputs and split rows without a text are found by counts observed
    while the parsed tables are written, not by further scans of the files.
    """
    from ..operators import ingest
    from ..sources.readers import read_corpus, read_split, read_test

    checkpoint_root(spark)
    corpus = ingest.parse_corpus(read_corpus(spark, corpus_path, multi_line), check=False).drop("_ord")
    corpus, seen = stored(corpus, "corpus")
    if not seen["rows"]:
        raise ValueError("corpus: no valid record is left after parsing")
    splits, missing = {}, {}
    for name, path in (("train", train_path), ("dev", dev_path)):
        joined = ingest.labelled_split(ingest.parse_split(read_split(spark, path)), corpus)
        splits[name], seen = stored(joined, name, missing=F.count_if(F.col("text").isNull()))
        missing[name] = seen["missing"]
    ingest.refuse_missing(missing)
    best, board, _ = select_model(splits["train"], splits["dev"])
    test = ingest.parse_test(read_test(spark, test_path, multi_line), check=False)
    return deliver(best, board, splits["dev"], test, folder, "_ord")
