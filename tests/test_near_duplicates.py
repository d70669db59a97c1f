import random

import pytest
from parity import compare, connect
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from corpuslens.operators import near_duplicates as nd
from corpuslens.sources.tables import materialize

SCHEMA = "row_id long, text string, digest string, size long, root long"


def brute(rows, percent, words):
    sets = []
    for _, text, *_ in rows:
        w = (text or "").split()
        sets.append({tuple(w[i : i + words]) for i in range(max(len(w) - words + 1, 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return sorted(((r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(rows)), key=repr)


def got(spark, rows, percent=nd.PERCENT, words=nd.WORDS, bits=nd.FREQUENCY_BITS):
    found = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA), F.col("text"), percent, words, bits).collect()
    assert all(r["kept"] == (r["row_id"] is not None and r["row_id"] == r["class_id"]) for r in found)
    return sorted(((r["row_id"], r["n_shingles"], r["class_id"]) for r in found), key=repr)


@pytest.mark.parametrize("percent,bits", [(92, nd.FREQUENCY_BITS), (60, 10), (60, 1)])
def test_matches_brute_force(spark, percent, bits):
    generator = random.Random(percent + bits)
    passage = [f"common{n}" for n in range(30)]
    rows = []
    for group in range(25):
        base = [f"w{generator.randrange(400)}" for _ in range(generator.randrange(3, 120))]
        for _ in range(generator.randrange(1, 8)):
            text = list(base) + (passage if group % 3 == 0 else [])
            for _ in range(generator.randrange(0, 4)):
                text[generator.randrange(len(text))] = f"x{generator.randrange(3)}"
            rows.append((len(rows), " ".join(text), "clash", 1, 2))
    # a chain whose ends are not similar
    rows += [(500 + n, " ".join(f"c{i}" for i in range(n * 3, n * 3 + 100)), None, None, None) for n in range(12)]
    assert got(spark, rows, percent, 3, bits) == brute(rows, percent, 3)


def test_edges(spark):
    long = "word " * 20_000 + "end"
    rows = [
        (1, "a b c d e f", None, None, None), (1, "a b c d e f", None, None, None), (1, "quite another text stands here too", None, None, None),
        (7, "a b c d e f", None, None, None), (2, None, None, None, None), (3, "", None, None, None), (4, " \n\t", None, None, None),
        (5, "two words", None, None, None), (6, "two words", None, None, None), (None, "two words", None, None, None),
        (None, "alone", None, None, None), (None, None, None, None, None), (8, long, None, None, None), (9, long, None, None, None),
    ]
    assert got(spark, rows) == brute(rows, nd.PERCENT, nd.WORDS)
    assert got(spark, []) == []


def test_large_group_has_few_candidates(spark):
    """Near copies of one text meet the smallest class of a shingle, not each other."""
    base = [f"w{n}" for n in range(400)]
    rows = [(n, " ".join([*base[:200], f"own{n}", *base[201:]]), None, None, None) for n in range(150)]
    assert {r[2] for r in got(spark, rows)} == {0}
    table = spark.createDataFrame(rows, SCHEMA)
    found = materialize(nd.marked(nd.hashed_words(table, F.col("text")), nd.PERCENT, nd.WORDS, nd.FREQUENCY_BITS), "marked")
    entries = found.select("digest", "size", F.posexplode("prefix").alias("at", "shingle"))
    star = materialize(nd.to_heads(entries, nd.PERCENT), "star")
    assert star.count() <= entries.count() < 150 * 40
    links = nd.similar(star, nd.sets_of(star, found, table, F.col("text"), nd.WORDS), nd.PERCENT)
    assert nd.across(entries, nd.components(links), nd.PERCENT).isEmpty()


def test_query_matches_sql(spark, small):
    good, note = compare(spark, connect(small), small, queries()["near_dup_classes"], oracle_sql()["near_dup_classes"])
    assert good, note
