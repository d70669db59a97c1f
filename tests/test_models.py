"""Fits, calibration, scoring, explanations, storage and streaming on a toy corpus."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.config import CharOptions, FeatureOptions, ModelOptions, ScoringOptions, WordOptions
from corpuslens.functions import text as tx
from corpuslens.operators import explain as ex
from corpuslens.operators.calibrate import fit_calibrated, fit_isotonic, fit_pipeline, fit_sigmoid
from corpuslens.operators.features import fit_features, tfidf_table, with_features
from corpuslens.operators.models import LinearModel
from corpuslens.operators.score import Calibrator, Member, TextModel, predict, scored_labels
from corpuslens.sources.models import load_model, save_model

TOY = FeatureOptions(WordOptions(min_df=1, max_df=1.0), CharOptions(enabled=True, min_df=1))


@pytest.fixture(scope="module")
def clean(corpus):
    return tx.with_normalized(corpus, {"text": "clean"}).cache()


@pytest.fixture(scope="module")
def bayes(clean):
    features, linear = fit_pipeline(clean, "naive_bayes", TOY)
    return TextModel((Member(features, linear),), version="test")


@pytest.fixture(scope="module")
def logistic(clean):
    features, linear = fit_pipeline(clean, "logistic_regression", TOY)
    return TextModel((Member(features, linear),), version="test")


def test_vectors_have_unit_blocks_and_match_the_long_table(clean):
    model = fit_features(clean, TOY)
    vectors = {r["row_id"]: r["features"] for r in with_features(clean, model).collect()}
    rows = tfidf_table(clean, model, "row_id").collect()
    position = {name: i for i, name in enumerate(model.names)}
    for r in rows:
        assert vectors[r["row_id"]][position[(r["space"], r["term"])]] == r["weight"]
    assert sum(v.numNonzeros() for v in vectors.values()) == len(rows)
    for v in vectors.values():
        assert abs(v.norm(2) - np.sqrt(2)) < 1e-12


@pytest.mark.parametrize("name", ["logistic_regression", "passive_aggressive", "linear_svm"])
def test_separable_corpus_is_learned(clean, name):
    features, linear = fit_pipeline(clean, name, TOY, ModelOptions(passive_aggressive_epochs=20))
    rows = scored_labels(clean, TextModel((Member(features, linear),))).collect()
    assert all(r["label"] == r["prediction"] for r in rows)


def test_logistic_gradient_vanishes(clean, logistic):
    member = logistic.members[0]
    rows = with_features(clean, member.features).collect()
    w = np.append(member.linear.coefficients, member.linear.intercept)
    gradient = w.copy()
    gradient[-1] = 0.0  # the intercept has no penalty
    for r in rows:
        x = np.append(r["features"].toArray(), 1.0)
        y = 1.0 if r["label"] == 1 else -1.0
        balance = len(rows) / 2 / sum(o["label"] == r["label"] for o in rows)
        gradient -= 2.0 * balance * y * x / (1.0 + np.exp(y * float(w @ x)))
    assert np.abs(gradient).max() < 0.02


def test_majority(clean):
    features, linear = fit_pipeline(clean, "dummy", TOY)
    assert {r["prediction"] for r in scored_labels(clean, TextModel((Member(features, linear),))).collect()} == {1}


def test_prediction_record(spark, logistic):
    df = spark.createDataFrame(
        [(0, "the harbour board signed the printed rainfall report"), (1, " "), (2, "wizards")],
        "i int, text string",
    )
    options = ScoringOptions(maximum_characters=500, minimum_words=5, minimum_coverage=0.0001, top_features=4)
    rows = {r["i"]: r for r in predict(df, logistic, "text", options).collect()}
    good = rows[0]
    assert good["label_predicted"] in (0, 1) and good["class_name"] in ("Fake News", "Real News")
    assert 0 <= good["estimated_model_probability"] <= 1 and good["score_kind"] == "probability"
    explanation = good["explanation"]
    for side in ("toward_fake", "toward_real"):
        assert len(explanation[side]) <= 4 and all(t["contribution"] > 0 for t in explanation[side])
    assert rows[1]["reject_reason"] and rows[1]["label_predicted"] is None
    assert rows[2]["warnings"]


def test_margin_models_have_no_confidence(spark, logistic):
    member = logistic.members[0]
    margin = LinearModel("m", member.linear.coefficients, member.linear.intercept, "margin")
    df = spark.createDataFrame([(0, "the harbour board")], "i int, text string")
    row = predict(df, TextModel((Member(member.features, margin),))).first()
    assert row["estimated_model_probability"] is None and row["confidence_band"] == "Unavailable"


def test_global_terms(spark, logistic, bayes):
    rows = ex.global_terms(spark, logistic, 3).collect()
    assert sorted(r["class"] for r in rows) == ["fake"] * 3 + ["real"] * 3
    assert ex.global_terms(spark, bayes, 3).count() == 0


def test_calibrators(spark):
    rng = np.random.default_rng(0)
    value = rng.normal(size=400)
    label = (rng.random(400) < 1 / (1 + np.exp(-2 * value + 0.5))).astype(int)
    df = spark.createDataFrame([(int(y), float(v)) for y, v in zip(label, value)], "label int, value double")
    sigmoid = fit_sigmoid(df)
    high, low = (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2)
    residual = np.where(label == 1, high, low) - sigmoid.apply(value)
    assert abs(residual.mean()) < 1e-4 and abs((residual * value).mean()) < 1e-4
    isotonic = fit_isotonic(df).apply(np.sort(value))
    assert (np.diff(isotonic) >= -1e-12).all() and 0 <= isotonic.min() and isotonic.max() <= 1


def test_ensemble_probabilities_and_storage(spark, clean, tmp_path):
    copies = clean.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(3))))
    many = copies.withColumn("row_id", F.col("row_id") + 10 * F.col("copy"))
    ensemble = fit_calibrated(many, "naive_bayes", ("sigmoid",), features=TOY)["sigmoid"]
    assert len(ensemble.members) == 3
    before = scored_labels(many, ensemble, "row_id").orderBy("row_id").collect()
    assert all(0 <= r["score"] <= 1 for r in before)
    path = str(tmp_path / uuid.uuid4().hex)
    save_model(spark, ensemble, path)
    after = scored_labels(many, load_model(spark, path), "row_id").orderBy("row_id").collect()
    assert before == after


def test_ensemble_contribution_averages_present_members(spark, clean, logistic):
    member = logistic.members[0]
    narrow = fit_features(clean.filter("row_id < 3"), TOY)
    second = LinearModel("n", np.ones(narrow.size), 0.0, "sigmoid")
    both = TextModel((member, Member(narrow, second)))
    parts = [
        {(r["row_id"], r["feature"]): r["contribution"] * (1 if r["direction"] == "real" else -1)
         for r in ex.local_terms(clean, TextModel((m,)), 500, "row_id").collect()}
        for m in both.members
    ]
    for r in ex.local_terms(clean, both, 500, "row_id").collect():
        key = (r["row_id"], r["feature"])
        mean = np.mean([p[key] for p in parts if key in p])
        assert abs(abs(mean) - r["contribution"]) < 1e-12


def test_stream_equals_batch(spark, logistic, tmp_path):
    from corpuslens.streaming.score import band_counts, score_stream, write_stream

    rows = [(i, f"official report number {i} about the hoax and the audit") for i in range(20)]
    df = spark.createDataFrame(rows, "i int, text string").withColumn(
        "at", F.timestamp_seconds(F.lit(1_500_000_000) + F.col("i") * 600)
    )
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    write_stream(score_stream(stream, logistic), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out")).select("i", "probability_real").orderBy("i").collect()
    batch = predict(df, logistic).select("i", "probability_real").orderBy("i").collect()
    assert streamed == batch
    counts = band_counts(score_stream(df, logistic), "at")
    assert counts.agg(F.sum("rows")).first()[0] == 20


def test_calibrator_shapes():
    knots = Calibrator("isotonic", np.array([0.0, 1.0]), np.array([0.2, 0.8]))
    assert np.allclose(knots.apply(np.array([-1.0, 0.5, 2.0])), [0.2, 0.5, 0.8])


def _vectors(spark, rows):
    from pyspark.ml.linalg import Vectors

    return spark.createDataFrame(
        [(i, y, Vectors.sparse(2, {0: float(x), 1: 1.0 if i % 3 else 0.5})) for i, (x, y) in enumerate(rows)],
        ["row_id", "label", "features"],
    )


@pytest.mark.parametrize("name", ["logistic_regression", "linear_svm", "passive_aggressive"])
def test_shifted_unbalanced_classes_need_an_intercept(spark, name):
    from corpuslens.operators.models import fit_classifier, margin

    rng = np.random.default_rng(3)
    x = np.concatenate([rng.uniform(0.0, 0.65, 360), rng.uniform(0.75, 1.0, 40)])
    scale = 1 if name == "passive_aggressive" else 20
    rows = _vectors(spark, [(v * scale, int(v > 0.7)) for v in x])
    model = fit_classifier(name, rows, 2)
    right = rows.filter((margin(model) > 0) == (F.col("label") == 1)).count()
    assert right >= (390 if name == "passive_aggressive" else 400)
    assert model.intercept < 0 and model.iterations > 0 and model.converged


def test_passive_aggressive_does_not_depend_on_partitions(spark):
    from corpuslens.operators.models import fit_passive_aggressive

    rng = np.random.default_rng(4)
    x = rng.normal(size=300)
    rows = _vectors(spark, [(v, int(v + 0.3 * rng.normal() > 0.4)) for v in x])
    fits = [fit_passive_aggressive(rows.repartition(n), 2, epochs=7) for n in (1, 4, 16)]
    for other in fits[1:]:
        assert (other.coefficients == fits[0].coefficients).all() and other.intercept == fits[0].intercept
