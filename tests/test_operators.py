"""Contracts, duplicates, order statistics, splits and metrics against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from corpuslens.config import ScoringOptions, SplitOptions
from corpuslens.errors import DataContractError, ModelNotReadyError
from corpuslens.operators import contract, dedup, metrics
from corpuslens.operators import score as sc
from corpuslens.operators import split as sp
from corpuslens.operators.leakage import term_frequencies
from corpuslens.operators.order import order_statistics, running_totals
from corpuslens.sources.csv import read_articles
from corpuslens.sources.models import load_model


def test_missing_values_and_columns(spark):
    df = spark.createDataFrame([(None, "body", 0)], "title string, text string, label int")
    assert contract.validate(df).first()["title"] == ""
    with pytest.raises(DataContractError):
        contract.validate(df.drop("text"))
    with pytest.raises(DataContractError):
        contract.check_labels(df.withColumn("label", F.lit(3)))


def test_csv_encodings_and_missing_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('title,text\n"x","line one\nline ""two"""\n'.encode())
    (tmp_path / "b.csv").write_bytes("title,text\ncaf\xe9,y\n".encode("latin-1"))
    rows = {r["title"]: r["text"] for r in read_articles(spark, str(tmp_path)).collect()}
    assert rows == {"x": 'line one\nline "two"', "caf\xe9": "y"}
    with pytest.raises(DataContractError):
        read_articles(spark, str(tmp_path / "missing.csv"))


def test_csv_binds_by_name(spark, tmp_path):
    folder = tmp_path / "with blank"
    folder.mkdir()
    (folder / "one file.csv").write_bytes(b"id,text,title\n7,BODY,HEAD\n")
    (folder / "two.csv").write_bytes("title,date,text\nT\xe9,,NA\n".encode("latin-1"))
    rows = {r["title"]: r.asDict() for r in read_articles(spark, str(folder)).collect()}
    assert (rows["HEAD"]["text"], rows["HEAD"]["id"], rows["HEAD"]["subject"]) == ("BODY", "7", None)
    assert (rows["T\xe9"]["text"], rows["T\xe9"]["date"]) == ("NA", None)
    (folder / "three.csv").write_bytes(b"headline,words\na,b\n")
    with pytest.raises(DataContractError):
        read_articles(spark, str(folder))


def test_dates_of_many_layouts(spark):
    from corpuslens.functions.dates import parse_date

    same = ["2017-12-31", "12/31/2017", "31/12/2017", "2017/12/31", "31 December 2017", "December 31, 2017", "Dec 31, 2017", "31-Dec-17", "31.12.2017"]
    timed = ["2017-12-31 10:15", "2017-12-31T10:15:00Z", "2017-12-31 10:15:00", "2017-12-31T12:15:00+02:00", "12/31/2017 10:15"]
    rows = spark.createDataFrame([(t,) for t in [*same, *timed, "soon", "", None, "2017-13-45"]], "t string")
    found = [r[0] for r in rows.select(parse_date(F.col("t")).cast("string")).collect()]
    assert set(found[: len(same)]) == {"2017-12-31 00:00:00"}
    assert set(found[len(same) : -4]) == {"2017-12-31 10:15:00"} and found[-4:] == [None] * 4


def test_totals_over_odd_scores(spark):
    rows = spark.createDataFrame([(x, 1) for x in (1.0, float("inf"), float("-inf"), float("nan"), 2.0, 2.0)], "s double, n int")
    found = {str(r["s"]): r["cum_n"] for r in running_totals(rows, "s", ["n"]).collect()}
    assert found == {"nan": 1, "inf": 2, "2.0": 4, "1.0": 5, "-inf": 6}
    assert running_totals(rows.limit(0), "s", ["n"]).count() == 0


def test_digests_tell_nulls_apart(spark):
    from corpuslens.operators.profile import duplicate_rows

    rows = spark.createDataFrame([(None, "a"), ("", "a"), (None, "a"), ("a", None), ("a", "")], "title string, text string")
    assert duplicate_rows(rows).first()[0] == 1


def test_missing_model(spark, tmp_path):
    with pytest.raises(ModelNotReadyError):
        load_model(spark, str(tmp_path / "none"))


def brute_dedup(rows):
    seen, exact = set(), []
    for r in rows:
        key = (r["title"], r["text"], r["label"])
        if key not in seen:
            seen.add(key)
            exact.append(r)
    labels = {}
    for r in exact:
        labels.setdefault(r["document_hash"], set()).add(r["label"])
    consistent = [r for r in exact if len(labels[r["document_hash"]]) == 1]
    kept, hashes = [], set()
    for r in consistent:
        if r["document_hash"] not in hashes:
            hashes.add(r["document_hash"])
            kept.append(r["row_id"])
    stats = (len(rows) - len(exact), len(consistent) - len(kept), len(exact) - len(consistent))
    return kept, stats


def test_dedup_with_a_hot_text(spark):
    """A third of all rows share one text."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        body = "hot text" if i % 3 == 0 else f"{rng.choice('abcdef')} {rng.choice(['x', 'X', '<i>x</i>'])}"
        rows.append((i, "t", body, 1 if i % 3 == 0 else rng.randint(0, 1)))
    df = spark.createDataFrame(rows, "row_id bigint, title string, text string, label int")
    prepared = contract.prepare(df.repartition(5))
    kept, stats = dedup.remove_duplicates(prepared)
    want, counts = brute_dedup(prepared.orderBy("row_id").collect())
    assert sorted(r["row_id"] for r in kept.collect()) == want
    assert tuple(stats.first()) == counts
    again, none = dedup.remove_duplicates(kept)
    assert again.count() == len(want) and sum(none.first()) == 0
    # Beyond the broadcast bound the same rows remain.
    groups = dedup.hash_groups(prepared)
    wide = dedup.keep_ids(prepared, dedup.survivors(groups), dedup.BROADCAST_IDS + 1)
    assert sorted(r["row_id"] for r in wide.collect()) == want


def test_order_statistics_with_hot_values(spark):
    rng = random.Random(5)
    rows = [(rng.choice([7, 7, 7, rng.randint(-(10**12), 10**12)]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k bigint, id bigint").repartition(6)
    ordered = sorted(rows)
    ranks = [0, 1, 700, 1500, 2200, 2999]
    for bins, leaf in ((16, 10), (4096, 5000)):
        found = order_statistics(df, ["k", "id"], ranks, bins=bins, leaf=leaf)
        assert found == {r: ordered[r] for r in ranks}
    doubles = [(rng.random() ** 9,) for _ in range(2000)] + [(0.5,)] * 1000
    frame = spark.createDataFrame(doubles, "k double")
    found = order_statistics(frame, ["k"], [0, 1999, 2999], bins=8, leaf=4)
    assert found == {r: sorted(doubles)[r] for r in (0, 1999, 2999)}


def test_running_totals(spark):
    rng = random.Random(6)
    rows = [(round(rng.random(), 2), 1) for _ in range(2000)]
    got = running_totals(spark.createDataFrame(rows, "k double, v bigint"), "k", ["v"], buckets=16)
    for r in got.collect():
        assert r["cum_v"] == sum(1 for k, _ in rows if k >= r["k"])


def test_splits(spark):
    rows = [(i, f"title {i % 40}", f"text {i}", int(i % 7 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id bigint, title string, text string, label int")
    prepared = contract.prepare(df)
    grouped = sp.split_groups(prepared)
    per_group = grouped.groupBy("title_group").agg(F.count_distinct("split").alias("n"))
    assert per_group.agg(F.max("n")).first()[0] == 1
    stratified = sp.split_stratified(prepared)
    table = {r["split"]: (r["label_0"], r["label_1"]) for r in sp.split_pivot(stratified).collect()}
    assert table == {"train": (239, 40), "validation": (51, 9), "test": (52, 9)}
    shuffled = sp.split_stratified(prepared.repartition(7))
    assert sorted(map(tuple, stratified.select("row_id", "split").collect())) == sorted(
        map(tuple, shuffled.select("row_id", "split").collect())
    )
    folds = sp.assign_folds(prepared, 5).groupBy("label", "fold").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in folds if r["label"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert sp.split_overlap(grouped).first().asDict()["train_test"] == 0


def test_time_split_falls_back(spark):
    rows = [(i, "t", f"x {i}", 0, f"January {i % 28 + 1}, 2017") for i in range(50)]
    df = spark.createDataFrame(rows, "row_id bigint, title string, text string, label int, date string")
    prepared = contract.prepare(df)
    timed = sp.assign_splits(prepared, SplitOptions(strategy="time_aware"))
    assert timed.applied == "time_aware"
    latest = timed.rows.groupBy("split").agg(F.max("date"), F.count("*").alias("n")).collect()
    assert {r["split"]: r["n"] for r in latest} == {"train": 35, "validation": 7, "test": 8}
    undated = prepared.withColumn("date", F.lit("soon"))
    back = sp.assign_splits(undated, SplitOptions(strategy="time_aware"))
    assert (back.requested, back.applied) == ("time_aware", "duplicate_safe")


def test_metrics_edge_cases(spark):
    one = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2)], "label int, prediction int, score double")
    got = metrics.evaluate(one, "probability")
    assert "roc_auc" not in got and got["recall"] == 0.5 and got["precision"] == 1.0
    tied = spark.createDataFrame([(1, 1, 0.5), (0, 1, 0.5)], "label int, prediction int, score double")
    assert metrics.evaluate(tied, "decision_score")["roc_auc"] == 0.5
    assert "brier_score" not in metrics.evaluate(tied, "decision_score")


def test_input_gate(spark):
    hindi = "यह एक समाचार परीक्षण वाक्य है"
    df = spark.createDataFrame([(0, ""), (1, None), (2, "word " * 300), (3, hindi), (4, "rumor")], "i int, text string")
    rows = {r["i"]: r for r in sc.assess(df, "text", ScoringOptions(maximum_characters=500, minimum_words=5)).collect()}
    assert rows[0]["reject_reason"] == rows[1]["reject_reason"] == sc.BLANK
    assert "500-character" in rows[2]["reject_reason"]
    assert sc.FOREIGN in rows[3]["warnings"]
    assert len(rows[4]["warnings"]) == 1


def test_empty_vocabulary_is_empty(spark):
    df = spark.createDataFrame([("the of", 0)], "content string, label int")
    assert term_frequencies(df).count() == 0
