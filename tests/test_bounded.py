"""What is held at a time does not follow the size of a batch; texts are normalised once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corpuslens.functions import unicode as uni
from corpuslens.operators import dedup
from corpuslens.operators import near_duplicates as nd


def test_decode_takes_runs_of_a_batch(spark, monkeypatch):
    monkeypatch.setattr(uni, "RUN_BYTES", 8)
    texts = ["ＡＢＣ", None, "plain", "", "a&amp;b ’x‘", "ﬁ", "é" * 50, "é"]
    assert [len(part) for part in uni._decode.func(iter([pa.array(texts)]))] == [len(texts)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    found = [r[0] for r in rows.select("i", uni.decode(F.col("t")).alias("t")).orderBy("i").select("t").collect()]
    assert found == ["ABC", None, "plain", "", "a&b 'x'", "fi", "é" * 50, "é"]


def test_stable_characters_need_no_decoding(spark):
    texts = ["plain", "naïve", "日本語", "straße — “x”", " ", "ﬁ", "é", "&amp;", "R&D", "& b", "\x00\x7f\n", "𝒳", ""]
    wanted = [False, False, False, False, True, True, True, True, True, False, False, True, False]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in rows.orderBy("i").select(uni.needs_decoding(F.col("t"))).collect()] == wanted


def test_shingles_are_cut_from_runs_of_rows(monkeypatch):
    monkeypatch.setattr(nd, "RUN_WORDS", 6)
    rows = [list(range(n)) for n in (7, 0, 3, 5, 9, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int64()))], names=["words"])
    whole = list(nd.shingle_sets(batch, 5))
    parts = list(nd.bounded(iter([batch])))
    cut = [own for part in parts for own in nd.shingle_sets(part, 5)]
    assert len(parts) > 2 and len(cut) == len(whole) == len(rows)
    assert all(np.array_equal(a, b) for a, b in zip(cut, whole))


def test_wanted_columns_are_computed_once(spark):
    rows = [(1, "t", "x", 0, 2, "aa"), (2, "t", "x", 0, 2, "aa"), (3, "t", "y", 0, 2, "aa"), (4, "u", "z", 1, 2, "bb"), (5, "u", "w", 0, 2, "bb"), (6, "v", None, 1, 1, "cc")]
    df = spark.createDataFrame(rows, "row_id long, title string, text string, label int, word_count int, document_hash string")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        runs.add(1)
        return value

    kept, stats = dedup.remove_duplicates(df.withColumn("document_hash", seen("document_hash")), "row_id", "document_hash")
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "aa"), (6, "cc")]
    assert runs.value == len(rows)
    whole, same = dedup.remove_duplicates(df)
    assert sorted(r["row_id"] for r in whole.collect()) == [1, 6] and stats.first() == same.first()
