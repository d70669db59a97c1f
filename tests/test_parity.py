"""A cross-section of the catalogue against DuckDB; ``python tests/parity.py`` runs all of it."""

import pytest
from parity import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

NAMES = (
    "normalize_text",
    "dedup_stats",
    "split_stratified",
    "leak_terms",
    "eda_bigrams",
    "class_report",
    "average_precision",
    "input_warnings",
    "feature_matrix",
)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, small, name):
    good, note = compare(spark, connect(small), small, queries()[name], oracle_sql()[name])
    assert good, note


def test_every_check_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["label", "rows"]
