import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpuslens.llm import infill


def brute(key, text, rate=100):
    text = text or ""
    lines = text.split("\n")
    units = [line + "\n" for line in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
    digest = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(rows, rate=100):
    for r in rows:
        assert tuple(r["infill"]) == brute(r["doc_id"], r["text"], rate), r["doc_id"]
        assert r["restored"] == (r["text"] or "")


def run(docs, **options):
    made = infill.transform(docs, **options)
    return made.withColumn("restored", infill.restore(F.col("infill.form"), F.col("infill.output"))).collect()


def test_matches_brute_force(spark):
    generator = random.Random(3)
    pieces = ["\n", "\r\n", "a", "é", "\U0001f600", "<", "P>", "<S", ">", " ", "\x0b", " ", "long line " * 9, "<M"]
    docs = [(n, "".join(generator.choice(pieces) for _ in range(generator.randrange(40)))) for n in range(600)]
    docs += [(1000, "<P>"), (1001, "\n"), (1002, "\n" * 5000), (1003, "x" * 300_000), (1004, "a\nb<M>c"), (-5, "a\nb")]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = run(table)
    check(rows)
    assert {r["infill"]["form"] for r in rows} == {"plain", "psm", "spm"}
    check(run(table, rate=40), 40)


def test_edges(spark, odd_docs, no_docs):
    rows = run(odd_docs)
    check(rows)
    assert len(rows) == odd_docs.count()
    assert infill.transform(no_docs).count() == 0
    clash = odd_docs.withColumnsRenamed({"lang": "whole", "source": "cut", "rep": "form", "score": "Output"})
    check(run(clash))


def test_other_units(spark):
    docs = spark.createDataFrame([(1, "one two  three"), (2, "a b")], "doc_id long, text string")
    rows = run(docs, unit=r"\S++\s*+|\s++")
    assert [r["infill"]["n"] for r in rows] == [3, 2] and all(r["restored"] == r["text"] for r in rows)


def test_unit_must_cover():
    import regex

    with pytest.raises(ValueError):
        infill.cuts(regex.compile("(a)*+"), "aab", 1, 2)
