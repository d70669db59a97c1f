import hashlib
import random
import re
import subprocess
import sys

import pytest

from corpuslens.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute(text, items):
    words = WORD.findall(lowered(text))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall(lowered(body))
        span = min(13, len(own))
        for i in range(len(own) - span + 1 if own else 0):
            for j in range(len(words) - span + 1):
                if words[j : j + span] == own[i : i + span]:
                    hit.update(range(j, j + span))
                    found.add(item)
    ids = sorted(map(str, found))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


@pytest.fixture(scope="module")
def case(spark):
    generator = random.Random(5)
    vocabulary = ["a", "b", "c", "ü", "7"]
    items = [(n, " ".join(generator.choice(vocabulary) for _ in range(generator.choice([0, 2, 5, 13, 20])))) for n in range(12)]
    docs = []
    for n in range(60):
        words = [generator.choice(vocabulary).upper() for _ in range(generator.randrange(40))]
        if n % 3 == 0:
            words[5:5] = generator.choice(items)[1].split()
        docs.append((n, ", ".join(words)))
    items += [(None, "a b"), (99, None), (1, items[2][1])]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_windows", [decontaminate.BLOCK_WINDOWS, 7])
def test_counts_match_brute_force(case, block_windows):
    docs, items, table, bench = case
    usable = [(i, t) for i, t in items if i is not None and t is not None]
    rows = decontaminate.digest(decontaminate.scan(table, bench, block_windows=block_windows)).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == {i: brute(t, usable) for i, t in docs}


@pytest.mark.parametrize("size", [1, 3, 100])
def test_passages_keep_every_window(spark, size):
    items = [(1, "A b, c! d é7 f g"), (1, "A b, c! d é7 f g"), (2, "a b"), (3, "\u212a x_y z"), (4, " .. "), (None, "a b c"), (5, None)]

    def windows(rows):
        cut = ((i, WORD.findall(lowered(t))) for i, t in rows)
        return {(i, tuple(w[n : n + 4])) for i, w in cut if w for n in range(max(len(w) - 3, 1))}

    found = decontaminate.passages(spark.createDataFrame(items, "item_id long, text string"), 4, size).collect()
    assert windows((r["item_id"], r["text"]) for r in found) == windows((i, t) for i, t in items if i is not None and t is not None)
    assert all(r["windows"] == max(len(r["text"].split()) - 3, 1) <= size for r in found)
    assert sum(r["windows"] for r in found) == 4 + 1 + 1


def test_an_automaton_of_a_full_block_is_bounded():
    code = """
import random, resource
from corpuslens.llm import decontaminate as d
g = random.Random(1)
words = [f"w{n}" for n in range(60_000)]
items = [(n, " ".join(g.choice(words) for _ in range(d.PASSAGE_WINDOWS + 12)).encode()) for n in range(d.BLOCK_WINDOWS // d.PASSAGE_WINDOWS)]
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
d.WindowAutomaton(items)
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    grown = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert grown < 1_000_000  # kilobytes


def test_two_characters_per_word():
    items = [(1, b"a b c d"), (2, b"d c b a e")]
    narrow, wide = decontaminate.WindowAutomaton(items, 3), decontaminate.WindowAutomaton(items, 3, codes=4)
    words = b"x a b c d c b a e e a b".split()
    assert (narrow.width, wide.width) == (1, 2)
    assert narrow.hits(words) == wide.hits(words) == ([[1, 8]], {1, 2})


def test_spans_point_into_the_original(spark):
    text = "Öl — ONE, two;THREE four"
    found = decontaminate.scan(
        spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    ).first()["contamination"]
    assert [text[s["start"] : s["end"]] for s in found["spans"]] == ["ONE, two;THREE"]


def test_edges(spark, odd_docs, no_docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    rows = decontaminate.digest(decontaminate.scan(odd_docs, bench)).collect()
    assert len(rows) == odd_docs.count()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in rows if r["contaminated"]) == [(0, 13), (1, 13), (2, 13), (2, 13)]
    assert decontaminate.scan(no_docs, bench).count() == 0
    nothing = decontaminate.digest(decontaminate.scan(odd_docs, bench.limit(0))).collect()
    assert {r["n_hit"] for r in nothing} == {0} and not any(r["contaminated"] for r in nothing)
