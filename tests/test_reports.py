"""Report sinks read back, and quantile sketches against exact ranks."""

import random
import uuid

import pytest

from corpuslens.operators import profile as pf
from corpuslens.sources.tables import read_csv_report, read_json_report, shared_root, write_csv_report, write_json_report

CELLS = ["plain", "", None, " padded ", "\ttab", 'say "no", twice', "two\nlines", "back\\slash", 'ends with \\"', "é 漢", ","]


@pytest.fixture
def folder(spark):
    return f"{shared_root(spark)}/reports-{uuid.uuid4().hex}"


def test_reports_come_back_unchanged(spark, folder):
    rows = list(enumerate(CELLS))
    table = spark.createDataFrame(rows, "row_id bigint, title string").repartition(3)
    write_csv_report(table, f"{folder}/csv")
    write_json_report(table, f"{folder}/json")
    blank = [(n, cell or None) for n, cell in rows]
    assert sorted(map(tuple, read_csv_report(spark, f"{folder}/csv", "row_id bigint, title string").collect())) == blank
    assert sorted(map(tuple, read_json_report(spark, f"{folder}/json", "row_id bigint, title string").collect())) == rows


def test_merged_sketches_stay_within_their_error(spark):
    generator = random.Random(4)
    rows = [(n % 7, int(generator.paretovariate(0.7)) if n % 3 else 5) for n in range(60_000)] + [(n, None) for n in range(9)]
    table = spark.createDataFrame(rows, "part int, size bigint").repartition(8)
    parts = pf.sketch_lengths(table, ("size",), ("part",))
    assert parts.count() == 9
    found = pf.sketch_quantiles(pf.merge_sketches(parts), (0.01, 0.5, 0.9, 0.999))
    errors = pf.rank_errors(table, found, ("size",)).collect()
    assert len(errors) == 4 and all(r["count"] == 60_000 and r["rank_error"] <= 0.01 for r in errors)


def test_sketches_of_nothing(spark):
    table = spark.createDataFrame([(1, None)], "part int, size bigint")
    rows = pf.sketch_quantiles(pf.sketch_lengths(table, ("size",), ("part",)), (0.5,), ("part",)).collect()
    assert [tuple(r) for r in rows] == [(1, "size", 0, 0.5, None)]
    assert pf.sketch_quantiles(pf.sketch_lengths(table.limit(0), ("size",), ("part",)), (0.5,), ("part",)).count() == 0
