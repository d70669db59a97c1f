"""Terms counted by batch against the term arrays of Spark expressions."""

from __future__ import annotations

from collections import Counter as Tally

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslens.config import CharOptions, FeatureOptions, WordOptions
from corpuslens.functions import grams, sparse
from corpuslens.operators import features as ft

TEXTS = [
    "the cat sat on the cat mat", "a", "", None, "  two  spaces around ", "straße été 日本語 𝒳𝒴 naïve naïve",
    "cat " * 50, "it's o'clock - well-known <b> o'clock", "x" * 300, "no cat never sat", "tab\tand\nline cat sat",
    "İstanbul ŞEHIR e\u0301te\u0301 \u0301cat -dash- 'quoted' a' x'y d'- can't² no1 _cat cat_ naïveté-", "日本cat cat日本 don't-- --cat K²at ſat",
]
OPTIONS = [
    FeatureOptions(WordOptions(min_df=1), CharOptions(min_df=1)),
    FeatureOptions(WordOptions(max_ngram=3, min_df=1, stop_words=()), CharOptions(min_n=2, max_n=2, min_df=1)),
    FeatureOptions(WordOptions(max_ngram=1, min_df=2, strip_accents=False), CharOptions(min_n=5, max_n=7, min_df=2)),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(TEXTS)], "row_id long, fold int, clean string").repartition(2)


def expected(rows, space, o):
    found = ft.with_terms(rows, space, "terms", o).select("row_id", "fold", "terms").collect()
    return {(r["row_id"], r["fold"]): Tally(r["terms"] or []) for r in found}


@pytest.mark.parametrize("limit", [1, 1 << 20])
@pytest.mark.parametrize("o", OPTIONS)
def test_counts_equal_term_arrays(spark, rows, o, limit, monkeypatch):
    monkeypatch.setattr(grams, "RUN_BYTES", limit)
    for space in (ft.WORD_SPACE, ft.CHAR_SPACE):
        terms = expected(rows, space, o)
        total, df = Tally(), Tally()
        for (_, fold), own in terms.items():
            for term, n in own.items():
                total[fold, term] += n
                df[fold, term] += 1
        counted = ft.counted_terms(rows, space, o, "fold").collect()
        assert {(r["fold"], r["term"]): (r["total"], r["df"]) for r in counted} == {k: (total[k], df[k]) for k in total}
        whole = ft.counted_terms(rows, space, o).collect()
        assert sum(r["total"] for r in whole) == sum(total.values()) and len(whole) == len({t for _, t in total})


@pytest.mark.parametrize("o", OPTIONS)
def test_table_equals_term_arrays(spark, rows, o):
    model = ft.fit_features(rows, o)
    found = Tally()
    for r in ft.tfidf_table(rows, model, "row_id").collect():
        found[r["row_id"], r["space"], r["term"]] += r["tf"]
    wanted = Tally()
    for s in model.spaces:
        for (row, _), own in expected(rows, s.name, o).items():
            wanted.update({(row, s.name, t): n for t, n in own.items() if t in set(s.terms)})
    assert found == wanted and len(found) > 10


def test_models_without_terms_score_every_row(spark, rows):
    none = FeatureOptions(WordOptions(min_df=100), CharOptions(min_df=100))
    vectors = ft.with_features(rows, ft.fit_features(rows, none))
    assert [r["nnz"] for r in ft.vector_stats(vectors, "features", "row_id").collect()] == [0] * len(TEXTS)


def test_occurrences_are_not_exploded(spark, rows):
    """Only distinct terms of a run of rows reach the exchange: before, every occurrence was a row of its own."""
    many = spark.range(2000).select(F.lit("the same few words again and again").alias("clean")).coalesce(1)
    plan = ft.counted_terms(many, ft.CHAR_SPACE, FeatureOptions())._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan


def test_runs_cover_all_rows():
    assert grams.runs(np.array([5, 0, 100, 1, 1]), 10) == [(0, 2), (2, 3)]
    assert grams.runs(np.array([], dtype=int), 10) == []
    assert sparse.row_ids(np.array([2, 0, 1])).tolist() == [0, 0, 2]
