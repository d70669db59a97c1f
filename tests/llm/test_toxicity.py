import random
import zlib

import numpy as np

from corpuslens.llm import crf, toxicity


def brute_marginals(chain, emissions):
    """All labellings of a short text."""
    n = len(emissions)
    weights = []
    for code in range(1 << n):
        state, total = 0, 0.0
        for t in range(n):
            new = code >> t & 1
            total += chain.moves[state, new] + (emissions[t] if new else 0)
            state = new
        weights.append(np.exp(total))
    weights = np.array(weights)
    return [weights[[c >> t & 1 for c in range(1 << n)] == np.int64(1)].sum() / weights.sum() for t in range(n)]


def test_marginals_match_enumeration(monkeypatch):
    monkeypatch.setattr(crf, "SEGMENT", 3)  # texts span several segments
    generator = np.random.default_rng(4)
    chain = crf.Chain(moves=generator.normal(size=(2, 2)))
    lengths = np.array([7, 0, 1, 3, 4, 8])
    emissions = generator.normal(size=lengths.sum())
    prob, moved = crf.marginals(chain, emissions, crf.Layout(lengths), True)
    at = 0
    for length in lengths:
        if length:
            assert np.allclose(prob[at : at + length], brute_marginals(chain, emissions[at : at + length]))
        at += length
    assert np.isclose(moved.sum(), lengths.sum())
    assert np.isclose(moved[:, 1].sum(), prob.sum())


def labelled(spark, count=900):
    generator = random.Random(8)
    plain = ["".join(generator.choice("abcdefghij") for _ in range(6)) for _ in range(500)]
    bad, docs, labels = ["vilest", "rotter"], [], []
    for n in range(count):
        words = [generator.choice(plain) for _ in range(generator.randint(5, 80))]
        toxic = n % 5 == 0
        if toxic:
            for _ in range(2):
                words[generator.randrange(len(words))] = generator.choice(bad + ["zork" + generator.choice(plain)[:3]])
        docs.append((n, " ".join(words), "en", "s", 1))
        labels.append((n, 1, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_spans(spark):
    docs, labels = labelled(spark)
    chain = toxicity.train(docs, labels)
    rows = toxicity.score(docs, chain, keep=("doc_id", "text")).collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    right = [(r["toxicity"]["score"] >= toxicity.THRESHOLD) == (r["doc_id"] % 5 == 0) for r in held]
    assert len(held) > 100 and sum(right) / len(right) > 0.97
    marked = {r["text"][s["start"] : s["end"]].split()[0] for r in held for s in r["toxicity"]["spans"]}
    assert marked and sum(w[:4] in ("vile", "rott", "zork") for w in marked) / len(marked) > 0.9


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = labelled(spark, 300)
    held = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"
    flipped = labels.selectExpr("doc_id", "quality", f"CASE WHEN {held} THEN 1 - toxic ELSE toxic END AS toxic")
    one, other = toxicity.train(docs, labels), toxicity.train(docs, flipped)
    assert (one.weights == other.weights).all() and (one.head == other.head).all()


def test_edges(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 1, None), (None, 1, 1), (8, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int")
    for used in (labels, labels.limit(0)):
        rows = toxicity.score(odd_docs, toxicity.train(odd_docs, used), keep=tuple(odd_docs.columns)).collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["toxicity"]["score"] <= 1 for r in rows)
    assert toxicity.score(no_docs, crf.Chain()).count() == 0
