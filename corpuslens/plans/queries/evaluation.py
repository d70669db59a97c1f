"""Metrics on deterministic scores of the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.config import CLASS_NAMES
from corpuslens.operators import calibrate as cal
from corpuslens.operators import metrics as mt
from corpuslens.operators.split import assign_folds
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query, r6

# Pseudo-candidates for the selection queries: name, multiplier of the document id.
CANDIDATES = (
    ("dummy", 7919),
    ("naive_bayes", 104729),
    ("logistic_regression", 1299709),
    ("passive_aggressive", 15485863),
    ("linear_svm", 179424673),
)


def _scored(spark, sf_dir, multiplier: int = 7919):
    labels = fx.table(spark, sf_dir, "labels")
    score = ((F.col("doc_id") * multiplier) % 1000) / F.lit(1000.0)
    return labels.select(
        "doc_id",
        F.col("quality").alias("label"),
        score.alias("score"),
        (score > 0.5).cast("int").alias("prediction"),
    )


def scored_sql(multiplier: int = 7919) -> str:
    return f"""(SELECT doc_id, quality AS label, ((doc_id * {multiplier}) % 1000) / 1000.0::DOUBLE AS score,
   CAST(((doc_id * {multiplier}) % 1000) / 1000.0::DOUBLE > 0.5 AS INTEGER) AS prediction FROM labels)"""


def counts_sql(source: str, by: str = "") -> str:
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    parts = ", ".join(
        f"count(*) FILTER (label = {a} AND prediction = {b})::DOUBLE AS {n}"
        for n, (a, b) in cells.items()
    )
    return f"SELECT {by + ', ' if by else ''}{parts} FROM {source} s {'GROUP BY ' + by if by else ''}"


def _div(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0 ELSE ({a})::DOUBLE / ({b}) END)"


F1_0, F1_1 = _div("2 * tn", "2 * tn + fp + fn"), _div("2 * tp", "2 * tp + fp + fn")
MACRO_F1 = f"(({F1_0} + {F1_1}) / ((tn + fp + fn > 0)::INT + (tp + fn + fp > 0)::INT))"
WEIGHTED_F1 = _div(f"{F1_0} * (tn + fp) + {F1_1} * (tp + fn)", "tn + fp + fn + tp")
THRESHOLD = {
    "accuracy": _div("tn + tp", "tn + fp + fn + tp"),
    "precision": _div("tp", "tp + fp"),
    "recall": _div("tp", "tp + fn"),
    "f1": F1_1,
    "macro_f1": MACRO_F1,
    "weighted_f1": WEIGHTED_F1,
}


@query(
    "metrics_threshold",
    "SELECT "
    + ", ".join(f"round({e}, 6) AS \"{n}\"" for n, e in THRESHOLD.items())
    + f" FROM ({counts_sql(scored_sql())}) c",
)
def metrics_threshold(spark, sf_dir):
    return mt.threshold_metrics(_scored(spark, sf_dir)).select(
        *[r6(n).alias(n) for n in THRESHOLD]
    )


@query(
    "confusion_matrix",
    f"""SELECT g.label, g.prediction, count(s.label) AS rows
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(label, prediction)
        LEFT JOIN {scored_sql()} s ON s.label = g.label AND s.prediction = g.prediction
        GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf_dir):
    return mt.confusion_matrix(_scored(spark, sf_dir))


def _report_sql() -> str:
    n0, n1 = "(tn + fp)", "(tp + fn)"
    zero = {"precision": _div("tn", "tn + fn"), "recall": _div("tn", "tn + fp"), "f1": F1_0}
    one = {"precision": _div("tp", "tp + fp"), "recall": _div("tp", "tp + fn"), "f1": F1_1}
    lines = [(CLASS_NAMES[0], zero, n0), (CLASS_NAMES[1], one, n1)]
    lines.append(("macro avg", {m: f"(({zero[m]} + {one[m]}) / 2)" for m in zero}, f"({n0} + {n1})"))
    weighted = {m: _div(f"{zero[m]} * {n0} + {one[m]} * {n1}", f"{n0} + {n1}") for m in zero}
    lines.append(("weighted avg", weighted, f"({n0} + {n1})"))
    return " UNION ALL ".join(
        f"SELECT '{name}' AS class_name, "
        + ", ".join(f"round({e}, 6) AS \"{m}\"" for m, e in values.items())
        + f", CAST({support} AS BIGINT) AS support FROM c"
        for name, values, support in lines
    )


@query("class_report", f"WITH c AS ({counts_sql(scored_sql())}) {_report_sql()}")
def class_report(spark, sf_dir):
    return mt.class_report(_scored(spark, sf_dir)).select(
        "class_name", *[r6(m).alias(m) for m in ("precision", "recall", "f1")], "support"
    )


_CURVE = f"""s AS (SELECT * FROM {scored_sql()} x),
points AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY 1),
curve AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
                 sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM points)"""


@query(
    "roc_auc",
    f"""WITH s AS (SELECT * FROM {scored_sql()} x)
        SELECT round(sum(CASE WHEN a.score > b.score THEN 1.0::DOUBLE WHEN a.score = b.score THEN 0.5::DOUBLE
                    ELSE 0.0::DOUBLE END) / count(*), 6) AS roc_auc
        FROM s a JOIN s b ON a.label = 1 AND b.label = 0""",
)
def roc_auc(spark, sf_dir):
    """Checked against all pairs of a positive and a negative row."""
    return mt.ranking_metrics(_scored(spark, sf_dir)).select(r6("roc_auc").alias("roc_auc"))


@query(
    "average_precision",
    f"WITH {_CURVE} SELECT round(sum(pos::DOUBLE / p * (tp::DOUBLE / (tp + fp))), 6) AS pr_auc FROM curve",
)
def average_precision(spark, sf_dir):
    return mt.ranking_metrics(_scored(spark, sf_dir)).select(r6("pr_auc").alias("pr_auc"))


@query(
    "roc_points",
    f"""WITH {_CURVE} SELECT score AS threshold, round(fp::DOUBLE / n, 6) AS fpr,
        round(tp::DOUBLE / p, 6) AS tpr FROM curve""",
)
def roc_points(spark, sf_dir):
    points = mt.roc_points(_scored(spark, sf_dir))
    return points.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query(
    "pr_points",
    f"""WITH {_CURVE} SELECT score AS threshold, round(tp::DOUBLE / (tp + fp), 6) AS precision,
        round(tp::DOUBLE / p, 6) AS recall FROM curve""",
)
def pr_points(spark, sf_dir):
    points = mt.pr_points(_scored(spark, sf_dir))
    return points.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


_P = "greatest(least(score, 1 - 1e-7::DOUBLE), 1e-7::DOUBLE)"
LOG_LOSS = f"avg(-ln(CASE WHEN label = 1 THEN {_P} ELSE 1 - {_P} END))"
BRIER = f"avg(pow({_P} - label, 2))"
_BIN = " + ".join(f"(p > {i / 10!r}::DOUBLE)::INT" for i in range(1, 10))
_BINNED = f"(SELECT label, p, {_BIN} AS bin FROM (SELECT label, {_P} AS p FROM {scored_sql()} x) y)"


@query(
    "prob_metrics",
    f"""SELECT round({LOG_LOSS}, 6) AS log_loss, round({BRIER}, 6) AS brier_score
        FROM {scored_sql()} x""",
)
def prob_metrics(spark, sf_dir):
    found = mt.probability_metrics(_scored(spark, sf_dir))
    return found.select(r6("log_loss").alias("log_loss"), r6("brier_score").alias("brier_score"))


@query(
    "ece",
    f"""SELECT round(sum(n::DOUBLE / total * abs(y - p)), 6) AS expected_calibration_error FROM (
          SELECT bin, count(*) AS n, avg(label) AS y, avg(p) AS p, sum(count(*)) OVER () AS total
          FROM {_BINNED} b GROUP BY bin) t""",
)
def ece(spark, sf_dir):
    found = mt.probability_metrics(_scored(spark, sf_dir))
    return found.select(r6("expected_calibration_error").alias("expected_calibration_error"))


@query(
    "reliability",
    f"""WITH s AS (SELECT * FROM {scored_sql()} x),
        q AS (SELECT quantile_cont(score, [{', '.join(repr(i / 10) for i in range(1, 10))}]) AS e FROM s),
        b AS (SELECT s.*, len(list_filter(e, lambda x: score > x)) AS bin FROM s, q)
        SELECT CAST(bin AS INTEGER) AS bin, count(*) AS rows, round(avg(score), 6) AS mean_probability,
          round(avg(label), 6) AS observed_rate FROM b GROUP BY 1""",
)
def reliability(spark, sf_dir):
    points = mt.reliability_points(_scored(spark, sf_dir))
    return points.select(
        "bin",
        "rows",
        r6("mean_probability").alias("mean_probability"),
        r6("observed_rate").alias("observed_rate"),
    )


def _candidates(spark, sf_dir):
    """Macro F1 and Brier score of every pseudo-candidate on all labelled documents."""
    lines = []
    for position, (name, multiplier) in enumerate(CANDIDATES):
        scored = _scored(spark, sf_dir, multiplier)
        lines.append(
            scored.withColumns({"position": F.lit(position), "method": F.lit(name)})
        )
    union = lines[0]
    for line in lines[1:]:
        union = union.unionByName(line)
    p = mt.clipped(F.col("score"))
    brier = union.groupBy("position", "method").agg(
        F.avg((p - F.col("label")) * (p - F.col("label"))).alias("brier_score")
    )
    return mt.threshold_metrics(union, "position", "method").join(brier, ["position", "method"])


def _candidates_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT {k} AS position, '{name}' AS method, {MACRO_F1} AS macro_f1, {THRESHOLD['accuracy']} AS accuracy,
            (SELECT {BRIER} FROM {scored_sql(m)} x) AS brier_score FROM ({counts_sql(scored_sql(m))}) c"""
        for k, (name, m) in enumerate(CANDIDATES)
    )


@query(
    "select_model",
    f"""SELECT position, method, round(macro_f1, 6) AS macro_f1,
        CAST(row_number() OVER (ORDER BY macro_f1 DESC, position) AS INTEGER) AS rank
        FROM ({_candidates_sql()}) t""",
)
def select_model(spark, sf_dir):
    ranked = cal.select_model(_candidates(spark, sf_dir))
    return ranked.select("position", "method", r6("macro_f1").alias("macro_f1"), "rank")


@query(
    "select_calibrator",
    f"""SELECT method, round(brier_score, 6) AS brier_score, round(macro_f1, 6) AS macro_f1
        FROM ({_candidates_sql()}) t ORDER BY brier_score, t.macro_f1 DESC, method LIMIT 1""",
)
def select_calibrator(spark, sf_dir):
    best = cal.best_calibrator(_candidates(spark, sf_dir))
    return best.select("method", r6("brier_score").alias("brier_score"), r6("macro_f1").alias("macro_f1"))


@query(
    "calibration_gate",
    f"""WITH t AS ({_candidates_sql()})
        SELECT b.method AS base, c.method AS calibrated,
          c.brier_score < b.brier_score AND c.macro_f1 >= b.macro_f1 - 0.005::DOUBLE AS improved,
          b.position = 4 OR (c.brier_score < b.brier_score AND c.macro_f1 >= b.macro_f1 - 0.005::DOUBLE) AS deploy
        FROM t b JOIN t c ON c.position = (b.position + 1) % 5""",
)
def calibration_gate(spark, sf_dir):
    """Each pseudo-candidate against the next one; the last has no native probability."""
    base = _candidates(spark, sf_dir)
    names = ("method", "brier_score", "macro_f1")
    after = base.select(
        ((F.col("position") + 4) % 5).alias("position"), *[F.col(n).alias(f"c_{n}") for n in names]
    )
    pairs = base.join(after, "position")
    native = F.when(F.col("position") != 4, F.col("brier_score"))
    values = (F.col("macro_f1"), F.col("c_brier_score"), F.col("c_macro_f1"))
    return pairs.select(
        F.col("method").alias("base"),
        F.col("c_method").alias("calibrated"),
        cal.calibration_improved(F.col("brier_score"), *values).alias("improved"),
        cal.use_calibrated(native, *values).alias("deploy"),
    )


@query(
    "cv_fold_metrics",
    f"""WITH o AS (SELECT *, ntile(5) OVER (PARTITION BY label ORDER BY
          {fx.hash60_sql("doc_id || '|42'")}, doc_id) - 1 AS fold FROM {scored_sql()} x)
        SELECT round(avg(f), 6) AS cv_macro_f1_mean, round(stddev_pop(f), 6) AS cv_macro_f1_std
        FROM (SELECT {MACRO_F1} AS f FROM ({counts_sql('o', 'fold')}) c) t""",
)
def cv_fold_metrics(spark, sf_dir):
    """Mean and population deviation of macro F1 over stratified folds of scored rows."""
    rows = _scored(spark, sf_dir).withColumnRenamed("doc_id", "row_id")
    per_fold = mt.threshold_metrics(assign_folds(rows, 5), "fold")
    return per_fold.agg(
        r6(F.avg("macro_f1")).alias("cv_macro_f1_mean"),
        r6(F.stddev_pop("macro_f1")).alias("cv_macro_f1_std"),
    )
