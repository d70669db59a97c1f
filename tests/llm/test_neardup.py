import random

import numpy as np

from corpuslens.llm import neardup
from corpuslens.llm.superminhash import UNSET, shingle_sets, signatures


def brute(docs):
    sets = {}
    for i, text in docs:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def corpus(seed=2):
    generator = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    docs, number = [], 0
    for _ in range(12):
        base = [generator.choice(vocabulary) for _ in range(generator.choice([3, 40, 120, 400]))]
        for _ in range(generator.choice([1, 4, 25])):
            words = list(base)
            for _ in range(generator.choice([0, 1, 2, 5])):
                words[generator.randrange(len(words))] = generator.choice(vocabulary)
            docs.append((number, " ".join(words)))
            number += 1
    return docs


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect()}


def test_components_match_brute_force(spark):
    docs = corpus()
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(neardup.near_duplicates(table)) == brute(docs)
    assert found(neardup.near_duplicates(table, block_rows=4)) == brute(docs)


def test_chain_of_links(spark):
    words = [f"x{n}" for n in range(200)]
    docs = [(n, " ".join(words[4 * n :] + [f"y{k}" for k in range(4 * n)])) for n in range(20)]
    assert found(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)


def test_long_paths_contract(spark):
    edges = spark.createDataFrame([(n + 1, n) for n in range(300)] + [(1000, 1001)], "a long, b long").repartition(7)
    labels = {r["node"]: r["component"] for r in neardup.components(edges).collect()}
    assert labels == {n: 0 for n in range(301)} | {1000: 1000, 1001: 1000}


def test_signature_is_a_superminhash():
    sets = shingle_sets([[b"w%d" % n for n in range(size)] for size in (0, 1, 6, 30, 3000)])
    signed = signatures(sets, 16)
    assert (signed[0] == UNSET).all()
    # one element fills all slots, with each rank once
    assert sorted((signed[1] >> np.uint64(32)).tolist()) == list(range(16))
    assert (signed[4] >> np.uint64(32)).max() <= 1
    again = signatures(list(reversed(sets)), 16, group=1)
    assert (again[::-1] == signed).all()


def test_signatures_estimate_similarity():
    a, b = [b"w%d" % n for n in range(1000)], [b"w%d" % n for n in range(100, 1100)]
    sets = shingle_sets([a, b])
    signed = signatures(sets, 512)
    truth = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs((signed[0] == signed[1]).mean() - truth) < 0.08


def test_edges(spark, odd_docs, no_docs):
    rows = neardup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[3]["n_shingles"] == by[4]["n_shingles"] == by[6]["n_shingles"] == 0
    assert by[3]["kept"] and by[4]["kept"] and by[5]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert neardup.near_duplicates(no_docs).count() == 0


def test_one_id_with_several_texts(spark):
    """Rows with one id are judged by their own texts, and a link held by one of them is not lost."""
    a, b, c = (" ".join(f"{name}{n}" for n in range(60)) for name in "abc")
    docs = [(1, a), (5, a + " more"), (5, b), (5, b), (5, c), (7, c + " x"), (9, b + " y")]
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["first"]) for r in rows)
    assert got == [(1, 56, 1, True), (5, 56, 5, True), (5, 56, 5, True), (5, 56, 5, True), (5, 57, 1, False), (7, 57, 5, False), (9, 57, 5, False)]


def test_blocks_are_cut_by_shingles(spark, monkeypatch):
    docs = corpus(5)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 300)
    assert found(neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))) == brute(docs)
