"""Evaluation of tables with ``label``, ``prediction`` and, for ranking metrics, ``score``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.config import CLASS_NAMES
from corpuslens.operators.order import order_statistics, running_totals

# Probability clipping and calibration bins.
CLIP = 1e-7
BINS = 10

_CELLS = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}


def _ratio(top: Column, bottom: Column) -> Column:
    """Division with 0 for an empty denominator."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)


def confusion_counts(df: DataFrame, *by: str) -> DataFrame:
    """tn, fp, fn, tp in one aggregate."""
    y, p = F.col("label"), F.col("prediction")
    return df.groupBy(*by).agg(
        *[F.count_if((y == a) & (p == b)).alias(name) for name, (a, b) in _CELLS.items()]
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """All four cells, empty ones included."""
    lines = [
        F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.col(name).alias("rows"))
        for name, (a, b) in _CELLS.items()
    ]
    return confusion_counts(df).select(F.inline(F.array(*lines)))


def _per_class() -> dict[str, dict[str, Column]]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        CLASS_NAMES[0]: {
            "precision": _ratio(tn, tn + fn),
            "recall": _ratio(tn, tn + fp),
            "f1": _ratio(2 * tn, 2 * tn + fp + fn),
            "support": tn + fp,
        },
        CLASS_NAMES[1]: {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
            "support": tp + fn,
        },
    }


def _averages() -> dict[str, dict[str, Column]]:
    negative, positive = _per_class().values()
    total = negative["support"] + positive["support"]
    macro, weighted = {"support": total}, {"support": total}
    # A class without rows and without predictions is not part of the averages' class list.
    seen = [
        (c["support"] + extra) > 0
        for c, extra in ((negative, F.col("fn")), (positive, F.col("fp")))
    ]
    count = reduce(lambda a, b: a + b, [s.cast("int") for s in seen])
    for metric in ("precision", "recall", "f1"):
        macro[metric] = _ratio(negative[metric] + positive[metric], count)
        weighted[metric] = _ratio(
            negative[metric] * negative["support"] + positive[metric] * positive["support"], total
        )
    return {"macro": macro, "weighted": weighted}


def threshold_metrics(df: DataFrame, *by: str) -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1, macro F1 and weighted F1."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    positive, averages = _per_class()[CLASS_NAMES[1]], _averages()
    return confusion_counts(df, *by).select(
        *by,
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        positive["precision"].alias("precision"),
        positive["recall"].alias("recall"),
        positive["f1"].alias("f1"),
        averages["macro"]["f1"].alias("macro_f1"),
        averages["weighted"]["f1"].alias("weighted_f1"),
    )


def class_report(df: DataFrame) -> DataFrame:
    """Per-class lines, then macro and weighted averages over both classes."""
    negative, positive = _per_class().values()
    total = negative["support"] + positive["support"]
    lines = dict(_per_class())
    lines["macro avg"] = {
        m: (negative[m] + positive[m]) / 2 for m in ("precision", "recall", "f1")
    } | {"support": total}
    lines["weighted avg"] = {
        m: _ratio(negative[m] * negative["support"] + positive[m] * positive["support"], total)
        for m in ("precision", "recall", "f1")
    } | {"support": total}
    rows = [
        F.struct(F.lit(name).alias("class_name"), *[c.alias(m) for m, c in line.items()])
        for name, line in lines.items()
    ]
    return confusion_counts(df).select(F.inline(F.array(*rows)))


def ranked(df: DataFrame) -> DataFrame:
    """Distinct scores, highest first, with rows of each class and their running totals."""
    marks = df.select(
        F.col("score").cast("double").alias("score"),
        (F.col("label") == 1).cast("bigint").alias("positives"),
        (F.col("label") == 0).cast("bigint").alias("negatives"),
    )
    return running_totals(marks, "score", ["positives", "negatives"])


def ranking_metrics(df: DataFrame) -> DataFrame:
    """Tie-aware ROC AUC and average precision; null unless both classes are present."""
    p, n = F.col("positives"), F.col("negatives")
    up, un = F.col("cum_positives"), F.col("cum_negatives")
    sums = ranked(df).agg(
        F.sum(p).alias("p"),
        F.sum(n).alias("n"),
        F.sum(n * (up - p / 2.0)).alias("area"),
        F.sum(p * (up / (up + un))).alias("steps"),
    )
    both = (F.col("p") > 0) & (F.col("n") > 0)
    pairs = F.col("p").cast("double") * F.col("n")
    return sums.select(
        F.when(both, F.col("area") / pairs).alias("roc_auc"),
        F.when(both, F.col("steps") / F.col("p")).alias("pr_auc"),
    )


def _with_totals(points: DataFrame) -> DataFrame:
    totals = points.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    one = F.lit(1).alias("__one")
    return points.select("*", one).join(F.broadcast(totals.select("*", one)), "__one")


def roc_points(df: DataFrame) -> DataFrame:
    """One point per distinct threshold; the origin is implied."""
    return _with_totals(ranked(df)).select(
        F.col("score").alias("threshold"),
        _ratio(F.col("cum_negatives"), F.col("n")).alias("fpr"),
        _ratio(F.col("cum_positives"), F.col("p")).alias("tpr"),
    )


def pr_points(df: DataFrame) -> DataFrame:
    up, un = F.col("cum_positives"), F.col("cum_negatives")
    return _with_totals(ranked(df)).select(
        F.col("score").alias("threshold"),
        (up / (up + un)).alias("precision"),
        _ratio(up, F.col("p")).alias("recall"),
    )


def clipped(score: Column) -> Column:
    return F.greatest(F.least(score, F.lit(1 - CLIP)), F.lit(CLIP))


def _bin_of(p: Column) -> Column:
    """Bin number of (lower, upper] intervals of equal width."""
    edges = [i / BINS for i in range(1, BINS)]
    return reduce(lambda a, b: a + b, [(p > e).cast("int") for e in edges])


def probability_metrics(df: DataFrame) -> DataFrame:
    """Log loss, Brier score and expected calibration error from one pass over the rows."""
    p, y = F.col("p"), F.col("y")
    rows = df.select(
        clipped(F.col("score")).alias("p"), F.col("label").cast("double").alias("y")
    )
    per_bin = rows.groupBy(_bin_of(p).alias("bin")).agg(
        F.count("*").alias("n"),
        F.sum(p).alias("sum_p"),
        F.sum(y).alias("sum_y"),
        F.sum(-F.ln(F.when(y == 1, p).otherwise(1 - p))).alias("log_loss"),
        F.sum((p - y) * (p - y)).alias("brier"),
    )
    total = F.sum("n")
    both = (F.sum("sum_y") > 0) & (F.sum("sum_y") < total)
    return per_bin.agg(
        F.when(both, F.sum("log_loss") / total).alias("log_loss"),
        F.when(both, F.sum("brier") / total).alias("brier_score"),
        F.when(both, F.sum(F.abs(F.col("sum_y") - F.col("sum_p"))) / total).alias(
            "expected_calibration_error"
        ),
    )


def calibration_bins(df: DataFrame) -> DataFrame:
    """Rows, mean probability and observed rate of each occupied calibration bin."""
    rows = df.select(clipped(F.col("score")).alias("p"), F.col("label").cast("double").alias("y"))
    return rows.groupBy(_bin_of(F.col("p")).alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg("p").alias("mean_probability"),
        F.avg("y").alias("observed_rate"),
    )


def score_quantiles(df: DataFrame, shares: list[float]) -> list[float]:
    """Exact linearly interpolated quantiles of ``score``."""
    scores = df.select(F.col("score").cast("double").alias("score"))
    last = scores.count() - 1
    if last < 0:
        return []
    positions = [s * last for s in shares]
    ranks = sorted({min(int(p) + k, last) for p in positions for k in (0, 1)})
    found = {k: v[0] for k, v in order_statistics(scores, ["score"], ranks).items()}
    out = []
    for p in positions:
        low, high = found[int(p)], found[min(int(p) + 1, last)]
        out.append(low + (high - low) * (p - int(p)))
    return out


def reliability_points(df: DataFrame, bins: int = BINS) -> DataFrame:
    """Mean probability and observed rate in quantile bins of the scores."""
    edges = score_quantiles(df, [i / bins for i in range(1, bins)])
    p = F.col("score")
    place = reduce(lambda a, b: a + b, [(p > e).cast("int") for e in edges], F.lit(0))
    return df.groupBy(place.alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg("score").alias("mean_probability"),
        F.avg(F.col("label").cast("double")).alias("observed_rate"),
    )


def evaluate(df: DataFrame, score_kind: str | None) -> dict[str, float | None]:
    """All scalar metrics of one scored table; metrics that do not apply are absent."""
    out = {"score_kind": score_kind, **threshold_metrics(df).first().asDict()}
    if score_kind is not None:
        more = ranking_metrics(df).first().asDict()
        if score_kind == "probability" and more["roc_auc"] is not None:
            more |= probability_metrics(df).first().asDict()
        out |= {k: v for k, v in more.items() if v is not None}
    return out
