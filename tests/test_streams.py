"""Windowed roll-ups: closed windows only, late rows out, the same result after a restart."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from corpuslens.operators import drift
from corpuslens.operators.split import split_rolling, split_sources
from corpuslens.streaming import rollup

START = datetime(2024, 3, 1)
SCHEMA = "at timestamp, kind string, value double"


def load(spark, rows, path):
    made = [(START + timedelta(hours=h), kind, v) for h, kind, v in rows]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def go_on(spark, base):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{base}/in")
    totals = rollup.window_totals(stream, "at", "value", ("kind",), "2 hours", "3 hours")
    query = rollup.append_closed(totals, f"{base}/out", f"{base}/state")
    query.awaitTermination()
    hour = (F.unix_timestamp("window_start") - F.unix_timestamp(F.lit(START))) / 3600
    rows = spark.read.schema("window_start timestamp, kind string, rows long, total double").parquet(f"{base}/out")
    return sorted((int(r[0]), r[1], r[2], r[3]) for r in rows.select(hour, "kind", "rows", "total").collect())


def test_windows_close_once_and_late_rows_stay_out(spark, tmp_path):
    base = str(tmp_path)
    load(spark, [(0, "a", 1.0), (1.5, "a", 2.0), (1, "b", 4.0), (4, "a", 8.0)], f"{base}/in")
    assert go_on(spark, base) == []  # the watermark stands at hour 1
    assert go_on(spark, base) == []  # a restart without new rows
    load(spark, [(1.9, "b", 16.0), (6, "a", 32.0)], f"{base}/in")
    first = [(0, "a", 2, 3.0), (0, "b", 2, 20.0)]
    assert go_on(spark, base) == first  # at hour 3: the first window is closed, the second open
    load(spark, [(0.5, "a", 64.0), (2.5, "b", 128.0), (9.5, "b", 256.0)], f"{base}/in")
    assert go_on(spark, base) == first + [(2, "b", 1, 128.0), (4, "a", 1, 8.0)]
    assert go_on(spark, base) == first + [(2, "b", 1, 128.0), (4, "a", 1, 8.0)]


def test_drift_of_slices(spark):
    rows = [(False, ["x", "x", "y"]), (True, ["x", "z"]), (None, ["w"]), (True, []), (False, None)]
    merged = drift.slice_terms(spark.createDataFrame(rows, "late boolean, terms array<string>"), "terms", F.col("late"))
    assert {tuple(r) for r in merged.collect()} == {("x", 2, 1), ("y", 1, 0), ("z", 0, 1)}
    row = drift.vocabulary_drift(merged).first()
    assert (row["reference_terms"], row["current_terms"], row["shared_terms"]) == (2, 2, 1)
    assert row["unknown_tokens"] == row["unknown_terms"] == 0.5
    p, q = {"x": 2 / 3, "y": 1 / 3, "z": 0}, {"x": 1 / 2, "y": 0, "z": 1 / 2}
    from math import log2

    wanted = sum(
        (s[t] * log2(s[t] / ((p[t] + q[t]) / 2)) if s[t] else 0) for t in "xyz" for s in (p, q)
    ) / 2
    assert abs(row["js_divergence"] - wanted) < 1e-12
    assert [r["term"] for r in drift.drifting_terms(merged, 2).collect()] == ["z", "y"]
    empty = drift.vocabulary_drift(merged.limit(0)).first()
    assert empty["reference_terms"] == 0 and empty["js_divergence"] is None


def test_rolling_windows(spark):
    days = [None, *[f"2024-01-{d:02d}" for d in range(1, 10)]]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "row_id long, date string")
    found = {}
    for r in split_rolling(rows, 4).collect():
        found.setdefault((r["window"], r["split"]), set()).add(r["row_id"])
    assert found[0, "train"] == {1, 2} and found[0, "test"] == {3, 4} and found[3, "test"] == {0, 9}
    assert found[3, "train"] == set(range(1, 9))
    last = {r["row_id"] for r in split_rolling(rows, 4, 1).where("window = 3 AND split = 'train'").collect()}
    assert last == {7, 8}
    assert split_rolling(rows.limit(0), 4).count() == 0
    assert split_rolling(rows.limit(2), 4).where("split = 'test'").count() <= 2


def test_no_source_in_two_splits(spark):
    sizes = {"a": 500, "b": 200, "c": 150, None: 100, "d": 50} | {f"s{n}": 1 for n in range(400)}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    table = spark.createDataFrame(rows, "row_id long, subject string")
    split = split_sources(table, heavy=0.01)
    assert split.columns == ["row_id", "subject", "split"] and split.count() == len(rows)
    where = {}
    for r in split.collect():
        where.setdefault(r["subject"], set()).add(r["split"])
    assert all(len(s) == 1 for s in where.values())
    assert (where["a"], where["b"], where["c"]) == ({"train"}, {"train"}, {"train"})
    shares = {r["split"]: r["count"] / len(rows) for r in split.groupBy("split").count().collect()}
    assert abs(shares["train"] - 0.7) < 0.06 and abs(shares["test"] - 0.15) < 0.06
    assert split_sources(table.limit(0)).count() == 0


def table_as_folder(spark, small, base, *folders):
    """The tables of ``small`` below ``base``, those named as folders of three files."""
    import os

    for name in ("documents", "labels", "conversations"):
        if name in folders:
            spark.read.parquet(f"{small}/{name}.parquet").repartition(3).write.parquet(f"{base}/{name}.parquet")
        else:
            os.symlink(f"{small}/{name}.parquet", f"{base}/{name}.parquet")
    return str(base)


def test_split_stream_reads_a_table_of_several_files(spark, small, tmp_path):
    from corpuslens.plans.queries.streams import split_group_stream

    wanted = sorted(map(tuple, split_group_stream(spark, small).collect()))
    found = split_group_stream(spark, table_as_folder(spark, small, tmp_path, "documents"))
    assert wanted and sorted(map(tuple, found.collect())) == wanted


def test_score_stream_reads_a_table_of_several_files(spark, small, tmp_path):
    from corpuslens.plans.queries.scoring import stream_score

    wanted = sorted(map(repr, stream_score(spark, small).collect()))
    found = stream_score(spark, table_as_folder(spark, small, tmp_path, "conversations"))
    assert wanted and sorted(map(repr, found.collect())) == wanted
