"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each job runs once to warm up and then ``$BENCH_RUNS`` times (default 1; model fits without warm-up); the
median counts. Results go to a sink that computes every row and column and stores nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from corpuslens.plans.queries import QUERIES
from corpuslens.session import local_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))

JOBS = (
    "normalize_text",
    "dedup_stats",
    "dedup_normalized",
    "split_group",
    "split_time",
    "leak_terms",
    "eda_bigrams",
    "tfidf",
    "feature_matrix",
    "roc_auc",
    "prob_metrics",
    "score_batch",
    "explain_local",
)
FITS = ("fit_naive_bayes", "fit_logistic", "fit_passive_aggressive", "fit_linear_svm")


def timed(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    results = {}
    for name in JOBS:
        timed(spark, name)
        results[name] = round(statistics.median(timed(spark, name) for _ in range(RUNS)), 3)
    for name in FITS:
        results[name] = round(timed(spark, name), 3)
    scale = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    line = {
        "metric": "total_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
