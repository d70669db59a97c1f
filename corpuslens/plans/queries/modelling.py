"""Fits, cross-validation, calibration and stored models on the articles."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.config import ProjectOptions
from corpuslens.functions import sparse
from corpuslens.operators import models as md
from corpuslens.operators import solver
from corpuslens.operators.calibrate import fit_calibrated, fit_pipeline
from corpuslens.operators.features import with_features
from corpuslens.operators.folds import FoldRun
from corpuslens.operators.metrics import threshold_metrics
from corpuslens.operators.score import Member, TextModel, scored_labels
from corpuslens.operators.validation import cv_summary as summarize
from corpuslens.operators.validation import fold_scores
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.features import FITTED, cleaned, fitted, tfidf_ctes
from corpuslens.plans.queries.registry import query, r6
from corpuslens.plans.train import COMPARISON, compare_candidates
from corpuslens.sources.models import load_model, model_tables, save_model
from corpuslens.sources.tables import materialize, shared_root, write_processed


def _train(rows):
    return rows.filter(F.col("split") == "train")


@query(
    "class_weights",
    f"""WITH {fx.ARTICLES}, c AS (SELECT label, count(*) AS rows FROM articles GROUP BY 1)
        SELECT label, rows, round(sum(rows) OVER ()::DOUBLE / (count(*) OVER () * rows), 6) AS weight FROM c""",
)
def class_weights(spark, sf_dir):
    return md.class_weights(fx.articles(spark, sf_dir)).withColumn("weight", r6("weight"))


@query(
    "fit_majority",
    f"""WITH {fx.SPLIT}, c AS (SELECT label, count(*) AS n FROM split WHERE split = 'train' GROUP BY 1)
        SELECT s.row_id, w.label AS prediction, w.label::DOUBLE AS score FROM split s,
          (SELECT label FROM c ORDER BY n DESC, label LIMIT 1) w""",
)
def fit_majority(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    features, linear = fit_pipeline(_train(rows), "dummy")
    scored = scored_labels(rows, TextModel((Member(features, linear),)), "row_id")
    return scored.select("row_id", "prediction", "score")


_BAYES = f"""WITH {FITTED}, {tfidf_ctes('train')}, sums AS (
  SELECT v.space, v.term, coalesce(sum(weight) FILTER (label = 0), 0) AS s0,
         coalesce(sum(weight) FILTER (label = 1), 0) AS s1
  FROM vocab v LEFT JOIN tfidf f ON f.space = v.space AND f.term = v.term
  LEFT JOIN train t ON t.row_id = f.row_id GROUP BY 1, 2),
total AS (SELECT sum(s0) AS t0, sum(s1) AS t1, count(*) AS v FROM sums),
prior AS (SELECT ln(count(*) FILTER (label = 1)::DOUBLE) - ln(count(*) FILTER (label = 0)::DOUBLE) AS b FROM train)
SELECT space, term, round((ln(s1 + 0.5) - ln(t1 + 0.5 * v)) - (ln(s0 + 0.5) - ln(t0 + 0.5 * v)), 6) AS log_odds,
       round(b, 6) AS prior_log_odds FROM sums, total, prior"""


@query("fit_naive_bayes", _BAYES)
def fit_naive_bayes(spark, sf_dir):
    """Log odds of every feature, and of the classes."""
    rows = cleaned(spark, sf_dir)
    features, linear = fit_pipeline(_train(rows), "naive_bayes")
    table = features.table(spark).select("space", "term", "index")
    odds = spark.createDataFrame(
        pa.table(
            {"index": np.arange(features.size, dtype=np.int32), "log_odds": linear.coefficients}
        )
    )
    return table.join(odds, "index").select(
        "space", "term", r6("log_odds").alias("log_odds"), r6(F.lit(linear.intercept)).alias("prior_log_odds")
    )


def _fit_report(spark, sf_dir, name: str):
    """Quality of one fitted candidate on each split."""
    rows = cleaned(spark, sf_dir)
    features, linear = fit_pipeline(_train(rows), name)
    scored = scored_labels(rows, TextModel((Member(features, linear),)), "split")
    metrics = threshold_metrics(scored, "split")
    return metrics.select(
        "split",
        F.lit(linear.score_kind).alias("score_kind"),
        F.lit(features.size).alias("features"),
        r6("accuracy").alias("accuracy"),
        r6("macro_f1").alias("macro_f1"),
    )


for _key, _name in (
    ("fit_logistic", "logistic_regression"),
    ("fit_passive_aggressive", "passive_aggressive"),
    ("fit_linear_svm", "linear_svm"),
):

    @query(_key)
    def fit_candidate(spark, sf_dir, name=_name):
        return _fit_report(spark, sf_dir, name)


_OPTIMUM = f"""WITH RECURSIVE {fx.ARTICLES}, data AS (
  SELECT CASE label WHEN 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS y, ln(1 + length(text)) / 10 AS x,
         count(*) OVER ()::DOUBLE / (2 * count(*) OVER (PARTITION BY label)) AS s FROM articles),
walk(loss, c, penalised, k, w, b) AS (
  SELECT loss, c, penalised, 0, 0.0::DOUBLE, 0.0::DOUBLE
  FROM (VALUES ('logistic', 2.0::DOUBLE), ('squared hinge', 1.0::DOUBLE)) l(loss, c), (VALUES (false), (true)) p(penalised)
  UNION ALL
  SELECT loss, c, penalised, k + 1, w - (h22 * g1 - h12 * g2) / (h11 * h22 - h12 * h12), b - (h11 * g2 - h12 * g1) / (h11 * h22 - h12 * h12)
  FROM (SELECT loss, c, penalised, k, w, b, w + c * sum(s * d1 * x) AS g1, b * penalised::INT + c * sum(s * d1) AS g2,
               1 + c * sum(s * d2 * x * x) AS h11, c * sum(s * d2 * x) AS h12, penalised::INT + c * sum(s * d2) AS h22
        FROM (SELECT walk.*, x, s,
                     CASE loss WHEN 'logistic' THEN -y / (1 + exp(y * (w * x + b))) ELSE -2 * y * greatest(0, 1 - y * (w * x + b)) END AS d1,
                     CASE loss WHEN 'logistic' THEN 1 / ((1 + exp(y * (w * x + b))) * (1 + exp(-y * (w * x + b))))
                       ELSE 2 * (y * (w * x + b) < 1)::INT END AS d2
              FROM walk, data WHERE k < 40) z
        GROUP BY loss, c, penalised, k, w, b) q)
SELECT loss, penalised, round(w, 6) AS weight, round(b, 6) AS intercept FROM walk WHERE k = 40"""


@query("solver_optimum", _OPTIMUM)
def solver_optimum(spark, sf_dir):
    """Both losses, with and without a penalty on the intercept, at their optimum over one feature: the text's length."""
    rows = fx.articles(spark, sf_dir)

    @F.arrow_udf(VectorUDT())
    def single(values):
        count = len(values)
        return sparse.pack(1, np.ones(count, np.int64), np.zeros(count, np.int32), np.asarray(values))

    vectors = rows.select("row_id", "label", single(F.log1p(F.length("text")) / 10).alias("features"))
    vectors = materialize(vectors, "lengths")
    weights = md.balanced(md.class_counts(vectors))
    cases = [(loss, c, penalised) for loss, c in (("logistic", 2.0), ("squared hinge", 1.0)) for penalised in (False, True)]
    fits = [
        (0, solver.trust_region_newton(loss, 1, (weights[0], weights[1]), c, penalise_intercept=penalised, tolerance=1e-11))
        for loss, c, penalised in cases
    ]
    with solver.dealt(vectors, vectors.count()) as data:
        found = solver.solve(data, [solver.View()], fits)
    lines = [(loss, penalised, *map(float, s.weights)) for (loss, _, penalised), s in zip(cases, found)]
    table = spark.createDataFrame(lines, "loss string, penalised boolean, weight double, intercept double")
    return table.select("loss", "penalised", r6("weight").alias("weight"), r6("intercept").alias("intercept"))


@query("cv_summary")
def cv_summary(spark, sf_dir):
    """Five folds of every candidate, each with its own vocabulary."""
    train = _train(cleaned(spark, sf_dir))
    candidates = ProjectOptions().models.candidates
    run = FoldRun(train, candidates)
    lines = [(name, *summarize(fold_scores(train, name, run=run))) for name in candidates]
    return spark.createDataFrame(lines, "model string, cv_macro_f1_mean double, cv_macro_f1_std double")


@query("model_comparison")
def model_comparison(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    options = ProjectOptions()
    validation = rows.filter(F.col("split") == "validation")
    _, _, lines = compare_candidates(_train(rows), validation, options)
    table = spark.createDataFrame(lines, COMPARISON)
    return table.select(
        "position", "model", "calibration", "accuracy", "macro_f1", "roc_auc", "brier_score",
        "cv_macro_f1_mean", "cv_macro_f1_std", "score_kind"
    ).orderBy(F.col("macro_f1").desc(), "position")


def _calibrated(spark, sf_dir, method: str):
    """Calibrated probabilities of every candidate."""
    rows = cleaned(spark, sf_dir)
    validation, parts = rows.filter(F.col("split") == "validation"), []
    options = ProjectOptions()
    run = FoldRun(_train(rows), options.models.candidates, folds=options.evaluation.calibration_folds)
    for name in options.models.candidates:
        ensemble = fit_calibrated(_train(rows), name, (method,), run=run)[method]
        scored = scored_labels(validation, ensemble, "row_id")
        parts.append(scored.select(F.lit(name).alias("model"), "row_id", "label", "prediction", r6("score").alias("probability")))
    return reduce(DataFrame.unionByName, parts)


@query("calibrate_sigmoid")
def calibrate_sigmoid(spark, sf_dir):
    return _calibrated(spark, sf_dir, "sigmoid")


@query("calibrate_isotonic")
def calibrate_isotonic(spark, sf_dir):
    return _calibrated(spark, sf_dir, "isotonic")


def _stored(spark, sf_dir) -> tuple[str, TextModel, object]:
    rows = cleaned(spark, sf_dir)
    features, linear = fit_pipeline(_train(rows), "naive_bayes")
    model = TextModel((Member(features, linear),), version="1.0.0")
    path = f"{shared_root(spark)}/corpuslens/model-{uuid.uuid4().hex}"
    save_model(spark, model, path)
    return path, model, rows


@query(
    "model_tables",
    f"""WITH {FITTED} SELECT space, count(*) AS terms, CAST(sum(df) AS BIGINT) AS df_sum,
        round(sum(idf), 6) AS idf_sum FROM vocab GROUP BY 1""",
)
def stored_tables(spark, sf_dir):
    """Vocabulary of a stored and reloaded model."""
    path, _, _ = _stored(spark, sf_dir)
    terms = model_tables(spark, load_model(spark, path))["terms"]
    return terms.groupBy("space").agg(
        F.count("*").alias("terms"), F.sum("df").alias("df_sum"), r6(F.sum("idf")).alias("idf_sum")
    )


@query("reevaluate")
def reevaluate(spark, sf_dir):
    """A stored model measured on the stored test split."""
    from corpuslens.plans.evaluate import evaluate_stored

    path, _, rows = _stored(spark, sf_dir)
    write_processed(rows, f"{path}/processed")
    return evaluate_stored(spark, path, f"{path}/processed")


