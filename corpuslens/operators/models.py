"""Linear classifiers over sparse TF-IDF vectors.

Every candidate ends up as one coefficient per feature and an intercept, so scoring, explaining
and storing need a single form.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.config import ModelOptions
from corpuslens.functions import sparse
from corpuslens.operators import solver
from corpuslens.operators.features import FeatureModel, counter_of
from corpuslens.operators.solver import Fit

PROBABILITY, DECISION = "probability", "decision_score"


@dataclass(frozen=True)
class LinearModel:
    """``link`` turns a margin into a score: constant class, sigmoid probability or the margin."""

    name: str
    coefficients: np.ndarray
    intercept: float
    link: str
    # Naive Bayes and the majority class score linearly but publish no coefficients.
    explainable: bool = True
    # Passes over the rows, and whether the fit ended before its limit; closed forms need none.
    iterations: int = 0
    converged: bool = True

    @property
    def score_kind(self) -> str:
        return DECISION if self.link == "margin" else PROBABILITY


def class_counts(df: DataFrame) -> dict[int, int]:
    rows = df.groupBy("label").agg(F.count("*").alias("n")).collect()
    return {r["label"]: r["n"] for r in rows}


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    counted = df.groupBy("label").agg(F.count("*").alias("rows"))
    # Two labels: the window partition holds two rows.
    whole = Window.partitionBy(F.lit(1))
    total, classes = F.sum("rows").over(whole), F.count("*").over(whole)
    return counted.select("label", "rows", (total / (classes * F.col("rows"))).alias("weight"))


def balanced(counts: dict[int, int]) -> dict[int, float]:
    total = sum(counts.values())
    return {k: total / (len(counts) * n) for k, n in counts.items()}


def fit_majority(df: DataFrame, size: int) -> LinearModel:
    return majority_model(class_counts(df), size)


def bayes_model(sums: dict[int, np.ndarray], counts: dict[int, int], size: int, alpha: float) -> LinearModel:
    """Multinomial naive Bayes in closed form from the class sums."""
    theta = {k: np.log(v + alpha) - np.log(v.sum() + alpha * size) for k, v in sums.items()}
    present = [k for k in (0, 1) if counts.get(k)]
    if len(present) < 2:
        return LinearModel("naive_bayes", np.zeros(size), 40.0 if present == [1] else -40.0, "sigmoid", False)
    prior = float(np.log(counts[1]) - np.log(counts[0]))
    return LinearModel("naive_bayes", theta[1] - theta[0], prior, "sigmoid", False)


def fit_naive_bayes(df: DataFrame, size: int, alpha: float = 0.5) -> LinearModel:
    """Naive Bayes of rows (row_id, label, features); class sums come from one pass over bounded blocks."""
    return _fitted("naive_bayes", df, size, ModelOptions(naive_bayes_alpha=alpha))


def majority_model(counts: dict[int, int], size: int) -> LinearModel:
    """Most frequent class; a tie goes to the lower label."""
    winner = min(counts, key=lambda k: (-counts[k], k)) if counts else 0
    return LinearModel("dummy", np.zeros(size), 1.0 if winner == 1 else -1.0, "constant", False)


def start_fit(
    name: str, size: int, counts: dict[int, int], o: ModelOptions = ModelOptions(), places: np.ndarray | None = None
) -> Fit:
    """The fit of one named candidate for ``solver.solve``; it returns a LinearModel.

    ``places`` are the features that the model keeps out of ``size`` shared ones; None keeps all.
    """
    kept = np.arange(size) if places is None else places
    balance = {k: balanced(counts).get(k, 0.0) for k in (0, 1)}
    weights = (balance[0], balance[1])
    if name == "dummy":
        return majority_model(counts, len(kept))
    if name == "naive_bayes":
        sums = yield from solver.summed_by_class(size)
        return bayes_model({k: v[kept] for k, v in sums.items()}, counts, len(kept), o.naive_bayes_alpha)
    if name == "logistic_regression":
        found = yield from solver.trust_region_newton(
            "logistic", size, weights, o.logistic_c, penalise_intercept=o.penalise_intercept, limit=o.logistic_max_iter
        )
        limit, link = f"{o.logistic_max_iter} iterations", "sigmoid"
    elif name == "linear_svm":
        found = yield from solver.trust_region_newton(
            "squared hinge", size, weights, o.svm_c, penalise_intercept=o.penalise_intercept, limit=o.svm_max_iter
        )
        limit, link = f"{o.svm_max_iter} iterations", "margin"
    elif name == "passive_aggressive":
        found = yield from solver.passive_aggressive(size, weights, o.passive_aggressive_c, limit=o.passive_aggressive_epochs)
        limit, link = f"{o.passive_aggressive_epochs} epochs", "margin"
    else:
        raise ValueError(f"Unknown model candidate: {name}")
    if not found.converged:
        warnings.warn(f"{name} stopped at its limit of {limit}", stacklevel=2)
    return LinearModel(name, found.weights[:size][kept], float(found.weights[size]), link, True, found.iterations, found.converged)


def _fitted(name: str, df: DataFrame, size: int, o: ModelOptions) -> LinearModel:
    counts = class_counts(df)
    with solver.dealt(df, sum(counts.values()), o.passive_aggressive_shards, name == "passive_aggressive") as data:
        return solver.solve(data, [solver.View()], [(0, start_fit(name, size, counts, o))])[0]


def fit_texts(name: str, df: DataFrame, features: FeatureModel, o: ModelOptions = ModelOptions()) -> LinearModel:
    """One named candidate on rows (row_id, label, clean), whose vectors are those of ``with_features``: they are made in their blocks."""
    counts = class_counts(df)
    view = solver.View(None, features.idf, tuple(int(e) for e in np.cumsum([len(s.terms) for s in features.spaces])))
    sublinear, whole_shards = tuple(s.sublinear for s in features.spaces), name == "passive_aggressive"
    rows = sum(counts.values())
    with solver.dealt_texts(df, rows, counter_of([features]), sublinear, [view], o.passive_aggressive_shards, whole_shards) as data:
        return solver.solve(data, [view], [(0, start_fit(name, features.size, counts, o))])[0]


def fit_logistic(df: DataFrame, size: int, c: float = 2.0, max_iter: int = 2000, penalise_intercept: bool = False) -> LinearModel:
    """Balanced L2 logistic regression of rows (row_id, label, features)."""
    o = ModelOptions(logistic_c=c, logistic_max_iter=max_iter, penalise_intercept=penalise_intercept)
    return _fitted("logistic_regression", df, size, o)


def fit_linear_svm(df: DataFrame, size: int, c: float = 1.0, max_iter: int = 1000, penalise_intercept: bool = False) -> LinearModel:
    """Balanced linear support vector machine with the squared hinge loss, of rows (row_id, label, features)."""
    return _fitted("linear_svm", df, size, ModelOptions(svm_c=c, svm_max_iter=max_iter, penalise_intercept=penalise_intercept))


def fit_passive_aggressive(df: DataFrame, size: int, c: float = 0.5, epochs: int = 1500, shards: int = 8) -> LinearModel:
    """Averaged passive-aggressive learning by iterative parameter mixing.

    Rows belong to a shard by a hash of ``row_id`` and stand in the order of that hash, so the result does not depend
    on how the input is partitioned. There are at least ``shards``, and more where rows would exceed ``solver.SHARD_ROWS`` in one.
    """
    o = ModelOptions(passive_aggressive_c=c, passive_aggressive_epochs=epochs, passive_aggressive_shards=shards)
    return _fitted("passive_aggressive", df, size, o)


def fit_classifier(
    name: str, df: DataFrame, size: int, o: ModelOptions = ModelOptions()
) -> LinearModel:
    """Fit one named candidate on (row_id, label, features)."""
    if name == "dummy":
        return fit_majority(df, size)
    if name == "naive_bayes":
        return fit_naive_bayes(df, size, o.naive_bayes_alpha)
    return _fitted(name, df, size, o)


def margin(model: LinearModel) -> Column:
    """Margin of the ``features`` column: dot product plus intercept."""
    w, b = model.coefficients, model.intercept

    @F.arrow_udf(T.DoubleType())
    def dot(vectors):
        lengths, index, value = sparse.unpack(vectors)
        return pa.array(sparse.row_sums(lengths, value * w[index]) + b)

    return dot("features")
