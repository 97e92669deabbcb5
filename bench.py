"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs twice in one session: the first (cold) run includes JIT /
codegen warm-up, the second (warm) is the steady state.  A run builds the
query and executes its whole plan into Spark's ``noop`` sink, so nothing is
collected.  Prints ONE JSON line; ``value`` is the sum of warm seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textlab.plans.catalog import QUERIES  # noqa: E402
from textlab.session import local_session  # noqa: E402

HEADLINE = [
    "labelled_split",        # J1: split LEFT JOIN corpus
    "token_stats",           # A4: exact median per class
    "class_distribution",    # A3: pivot
    "top_repeated_texts",    # A6: top-k over hashed text groups
    "kde_token_count",       # A7: grouped KDE
    "tfidf",                 # T1-T7: fit vocabulary + transform train
    "tfidf_transform",       # T8: transform dev + test
    "decision_score",        # M3
    "threshold_adaptive",    # M4
    "classification_report", # A10
    "top_false_positives",   # W2
    "model_selection",       # M6: two distributed solvers + tuning
    "score_test",            # M7: select + score the test split
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=max(2 * cpus, 8), app="textlab-bench")
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(run(spark, name, sf_dir), 3)
        print(f"# {name}: cold {cold[name]:.2f}s warm {warm[name]:.2f}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "headline_queries_warm_total",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
