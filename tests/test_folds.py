"""Fits in lockstep: optimality, equality with fits one by one, and the default cross-validation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.config import CharOptions, FeatureOptions, ModelOptions, WordOptions
from corpuslens.functions import text as tx
from corpuslens.operators import solver
from corpuslens.operators.calibrate import fit_pipeline
from corpuslens.operators.features import with_features
from corpuslens.operators.folds import WHOLE, FoldRun
from corpuslens.operators.models import fit_linear_svm, fit_logistic
from corpuslens.operators.score import Member, TextModel, scored_labels
from corpuslens.operators.split import assign_folds
from corpuslens.plans.queries.modelling import cv_summary

TOY = FeatureOptions(WordOptions(min_df=1, max_df=1.0), CharOptions(enabled=True, min_df=1))
NAMES = ("dummy", "naive_bayes", "logistic_regression", "passive_aggressive", "linear_svm")


@pytest.fixture(scope="module")
def clean(spark, corpus):
    rows = corpus.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(4))))
    rows = rows.withColumns({"row_id": F.col("row_id") + 10 * F.col("copy"), "text": F.concat("text", F.lit(" "), F.element_at(F.split("text", " "), F.col("copy") + 1))})
    return tx.with_normalized(rows, {"text": "clean"}).cache()


def test_folds_equal_fits_one_by_one(clean):
    run = FoldRun(clean, NAMES, folds=3, features=TOY, models=ModelOptions(passive_aggressive_epochs=15), whole=True).fit()
    folded = assign_folds(clean.select("row_id", "label", "clean"), 3, 42)
    for fold in (0, 2, WHOLE):
        inside = folded.filter(F.col("fold") != fold)
        for name in NAMES:
            features, linear = fit_pipeline(inside, name, TOY, ModelOptions(passive_aggressive_epochs=15))
            mine = run.members[name, fold]
            assert mine.features.names == features.names and np.allclose(mine.features.idf, features.idf)
            close = 2e-3 if name in ("logistic_regression", "linear_svm") else 1e-9
            assert np.allclose(mine.linear.coefficients, linear.coefficients, atol=close), (name, fold)
            assert abs(mine.linear.intercept - linear.intercept) < close
    held = {r["row_id"]: r["margin"] for r in run.held("logistic_regression").filter("fold = 1").collect()}
    rows = scored_labels(folded.filter("fold = 1"), TextModel((run.members["logistic_regression", 1],)), "row_id").collect()
    assert set(held) == {r["row_id"] for r in rows}
    assert all(abs(1 / (1 + np.exp(-held[r["row_id"]])) - r["score"]) < 1e-9 for r in rows)


@pytest.mark.parametrize("penalised", [False, True])
@pytest.mark.parametrize("loss", ["logistic", "squared hinge"])
def test_gradient_vanishes(clean, loss, penalised):
    features, _ = fit_pipeline(clean, "dummy", TOY)
    vectors = with_features(clean, features).select("row_id", "label", "features")
    fit = fit_logistic if loss == "logistic" else fit_linear_svm
    linear = fit(vectors, features.size, 2.0, 200, penalised)
    assert linear.converged and linear.iterations < 40
    rows = vectors.collect()
    x = np.array([np.append(r["features"].toArray(), 1.0) for r in rows])
    y = np.array([1.0 if r["label"] == 1 else -1.0 for r in rows])
    s = np.where(y > 0, len(y) / 2 / (y > 0).sum(), len(y) / 2 / (y < 0).sum())
    w = np.append(linear.coefficients, linear.intercept)
    z = y * (x @ w)
    slope = -1 / (1 + np.exp(z)) if loss == "logistic" else -2 * np.maximum(0, 1 - z)
    gradient = w + 2.0 * (x * (s * y * slope)[:, None]).sum(axis=0)
    if not penalised:
        gradient[-1] -= w[-1]
    assert np.linalg.norm(gradient) < 2e-3


def test_sums_by_tasks_equal_sums_by_driver(clean, monkeypatch):
    features, _ = fit_pipeline(clean, "dummy", TOY)
    vectors = with_features(clean, features).select("row_id", "label", "features").cache()
    one = fit_logistic(vectors, features.size)
    monkeypatch.setattr(solver, "DRIVER_BYTES", 0)
    monkeypatch.setattr(solver, "CHUNK", 7)
    two = fit_logistic(vectors, features.size)
    assert np.allclose(one.coefficients, two.coefficients, atol=1e-12)


def test_small_classes_and_empty_tables(spark, clean):
    one_class = clean.filter("label = 1")
    run = FoldRun(one_class, ("naive_bayes", "logistic_regression"), folds=1, features=TOY, whole=True).fit()
    assert run.effective == 0 and run.scores("naive_bayes") == []
    assert run.model("logistic_regression").members[0].linear.intercept > 0
    few = clean.filter("label = 1 OR row_id = 5")
    assert FoldRun(few, ("naive_bayes",), features=TOY).scores("naive_bayes") == []
    nothing = FoldRun(clean.limit(0), NAMES, features=TOY)
    assert nothing.scores("dummy") == []


def test_default_cross_validation_of_all_candidates(spark, small):
    rows = {r["model"]: r for r in cv_summary(spark, small).collect()}
    assert set(rows) == set(NAMES)
    assert all(0 <= r["cv_macro_f1_mean"] <= 1 and r["cv_macro_f1_std"] >= 0 for r in rows.values())


def test_member_of_every_fold_is_a_model(clean):
    run = FoldRun(clean, ("naive_bayes",), folds=2, features=TOY).fit()
    assert isinstance(run.members["naive_bayes", 0], Member) and ("naive_bayes", WHOLE) not in run.members


def test_blocks_are_bounded_and_keep_the_order(monkeypatch):
    import pickle

    import pyarrow as pa

    from corpuslens.functions import sparse

    monkeypatch.setattr(solver, "BLOCK_ENTRIES", 10)
    lengths = np.array([4, 0, 4, 4, 30, 1, 0])
    index, value = np.arange(lengths.sum()) % 7, np.arange(lengths.sum(), dtype=float)
    batch = pa.RecordBatch.from_pydict({
        "features": sparse.pack(7, lengths, index, value), "label": pa.array([1, 0, None, 1, 0, 1, 0], pa.int32()),
        "fold": pa.array([0] * 7, pa.int32()), "shard": pa.array([3] * 7, pa.int32()),
    })
    found = [pickle.loads(b.column("block")[0].as_py()) for b in solver.packed([batch, batch.slice(0, 0)])]
    assert all(f[0].sum() - f[0].max() <= 10 for f in found) and len(found) == 3
    for number, wanted in enumerate((lengths, index, value, [1, 0, -1, 1, 0, 1, 0], [0] * 7, [3] * 7)):
        assert np.concatenate([f[number] for f in found]).tolist() == list(wanted)


def test_sums_spread_over_more_partitions_than_shards(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr(solver, "SPREAD_ROWS", 20)
    rows = [(i, i % 2, Vectors.sparse(3, [i % 3], [1.0])) for i in range(1200)]
    table = spark.createDataFrame(rows, ["row_id", "label", "features"])
    for whole, parts in ((True, 8), (False, 24)):
        with solver.dealt(table, 1200, 8, whole) as data:
            assert data.parts == parts == data.blocks.getNumPartitions()
            sums = solver.solve(data, [solver.View()], [(0, solver.summed_by_class(3))])[0]
            assert sums[0].tolist() == sums[1].tolist() == [200.0] * 3


def test_ensembles_of_several_candidates_share_one_run(clean, monkeypatch):
    from corpuslens.operators import folds as fd
    from corpuslens.operators.calibrate import fit_calibrated

    counted = []
    vocabularies = fd.fold_vocabularies
    monkeypatch.setattr(fd, "fold_vocabularies", lambda *a: counted.append(1) or vocabularies(*a))
    names = ("dummy", "naive_bayes")
    run = FoldRun(clean, names, folds=3, features=TOY)
    shared = {n: fit_calibrated(clean, n, ("isotonic",), features=TOY, run=run)["isotonic"] for n in names}
    assert len(counted) == 1
    alone = fit_calibrated(clean, "naive_bayes", ("isotonic",), features=TOY)["isotonic"]
    for mine, other in zip(shared["naive_bayes"].members, alone.members):
        assert np.allclose(mine.linear.coefficients, other.linear.coefficients)
        assert np.allclose(mine.calibrator.x, other.calibrator.x) and np.allclose(mine.calibrator.y, other.calibrator.y)


def test_bayes_alone_takes_one_pass_over_blocks(spark, monkeypatch):
    from pyspark.ml.linalg import Vectors

    from corpuslens.operators.models import fit_classifier

    passes = []
    answered = solver.answered
    monkeypatch.setattr(solver, "answered", lambda *a: passes.append(1) or answered(*a))
    rows = [(i, int(i % 3 == 0), Vectors.sparse(4, [i % 4], [0.5])) for i in range(60)]
    linear = fit_classifier("naive_bayes", spark.createDataFrame(rows, ["row_id", "label", "features"]), 4)
    assert len(passes) == 1
    sums = np.zeros((2, 4))
    for i, label, _ in rows:
        sums[label, i % 4] += 0.5
    theta = np.log(sums + 0.5) - np.log(sums.sum(1, keepdims=True) + 2.0)
    assert np.allclose(linear.coefficients, theta[1] - theta[0]) and np.isclose(linear.intercept, np.log(20 / 40))


def test_every_partition_has_its_share_of_shards(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(i, i % 2, Vectors.sparse(3, [i % 3], [1.0])) for i in range(1200)]
    with solver.dealt(spark.createDataFrame(rows, ["row_id", "label", "features"]), 1200) as data:
        held = data.blocks.mapPartitions(lambda blocks: [sum(solver.Block(b).rows for b in blocks)]).collect()
    assert len(held) == 8 and sum(held) == 1200 and min(held) > 75 and max(held) < 300


@pytest.mark.parametrize("name", ["naive_bayes", "logistic_regression", "passive_aggressive", "linear_svm"])
def test_fits_of_texts_write_no_vectors(clean, monkeypatch, name):
    from corpuslens.operators import calibrate
    from corpuslens.operators.models import fit_classifier

    monkeypatch.setattr(solver, "TEXT_BYTES", 100)
    options = ModelOptions(passive_aggressive_epochs=6)
    features, _ = fit_pipeline(clean, "dummy", TOY)
    apart = fit_classifier(name, with_features(clean, features).select("row_id", "label", "features"), features.size, options)
    written = []
    monkeypatch.setattr(calibrate, "materialize", lambda df, name: written.append(name) or df)
    _, linear = fit_pipeline(clean, name, TOY, options)
    assert not written
    close = 2e-3 if name in ("logistic_regression", "linear_svm") else 1e-9
    assert np.allclose(linear.coefficients, apart.coefficients, atol=close) and abs(linear.intercept - apart.intercept) < close


def test_products_and_sums_of_blocks():
    generator = np.random.default_rng(5)
    lengths = np.array([70, 0, 130, 64])
    index = np.concatenate([np.sort(generator.choice(200, n, replace=False)) for n in lengths])
    value = generator.normal(size=lengths.sum())
    dense = np.zeros((4, 200))
    dense[np.repeat(np.arange(4), lengths), index] = value
    zero = np.zeros(4, np.int32)
    [packed] = [b.column("block")[0].as_py() for b in solver.blocks_of(lengths, index.astype(np.int32), value, zero, zero, zero)]
    block = solver.Block(packed)
    for columns in (1, 2, 9):  # one by one, and all at once
        wide, factors, total = generator.normal(size=(200, columns)), generator.normal(size=(columns, 4)), np.ones((columns, 200))
        assert np.allclose(block.products(wide), dense @ wide)
        block.scatter(factors, total)
        assert np.allclose(total, 1.0 + factors @ dense)
