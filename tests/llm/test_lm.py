import math
import random
import zlib
from collections import Counter

import numpy as np

from corpuslens.llm import lm


def brute(docs):
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode())
    seqs = [(i, (t or "").encode().lower().split() + [None]) for i, t in docs]
    c1, c2, k1, k2 = Counter(), Counter(), Counter(), Counter()
    taught = []
    for i, seq in seqs:
        if fold(i) % 7 == 2:
            continue
        gone = fold(i) // 7 % 10 == 0
        before = 0
        for own1, own2 in ((c1, c2), *(() if gone else ((k1, k2),))):
            before = 0
            own1[0] += 1
            for w in seq:
                own1[w] += 1
                own2[before, w] += 1
                before = w
        if gone:
            taught.append(seq)
    total, distinct = sum(c1.values()) - c1[0], len(c1) - (0 in c1)
    kept = max(sum(k1.values()) - k1[0], 1)
    place = lambda c: min(math.frexp(c)[1], lm.BUCKETS - 1)
    b, two, one = [], [], []
    for seq in taught:
        before = 0
        for w in seq:
            b.append(place(k1[before]))
            two.append(k2[before, w] / max(k1[before], 1))
            one.append(k1[w] / kept)
            before = w
    bins = [lm.unbinned(lm.binned(np.array(x, "f8"))) for x in (two, one)]
    mixture = lm.weights(np.array(b, "int64"), *bins, np.ones(len(b)), distinct)
    out = []
    for i, seq in seqs:
        before, base, score = 0, 0.0, 0.0
        for w in seq:
            m = mixture[place(c1[before])]
            base += math.log10((c1[w] + 1) / (total + distinct + 1))
            score += math.log10(m[0] * c2[before, w] / max(c1[before], 1) + m[1] * c1[w] / max(total, 1) + m[2] / (distinct + 1))
            before = w
        out.append((i, fold(i) % 7 == 2, len(seq), sum(c1[w] > 0 for w in seq), total, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-7)


def zipf(count=400):
    generator = random.Random(9)
    vocabulary = [f"w{n}" for n in range(300)]
    docs = []
    for n in range(count):
        at, words = 0, []
        for _ in range(generator.randrange(60)):
            at = (at * 7 + min(int(generator.paretovariate(0.8)), 40)) % 300
            words.append(vocabulary[at])
        docs.append((n, " ".join(words)))
    return docs


def test_matches_brute_force(spark):
    docs = zipf()
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs)
    same(lm.score(table).collect(), want)
    same(lm.score(table, chunk_bytes=4000).collect(), want)
    # more chunks than two levels of ranges put together
    same(lm.score(table, chunk_bytes=1000, fan_bits=2).collect(), want)
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_a_chunk_read_by_two_tasks_gets_one_answer():
    texts, flags = [b"a b a", b"b c"], [True, False]
    once = lm.counted_keys(texts, flags, flags)[1]
    rows = []
    for text, flag in zip(texts, flags):
        keys, n, h = lm.counted_keys([text], [flag], [flag])[1]
        rows.append((7, 1, 0, lm.pack(np.diff(keys, prepend=np.uint64(0))), lm.pack(n), lm.pack(h)))
    answers = lm.merge(lm.table_of(rows, lm.arrow_schema(lm.fields(lm.SENT)))).to_pylist()
    assert [r["p"] for r in answers] == [7, None]
    assert lm.unpack(answers[0]["n"]).tolist() == once[1].tolist()


def test_split_planning_does_not_matter(spark, tmp_path):
    docs = zipf(200)
    spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).write.option("parquet.block.size", 4096).parquet(str(tmp_path / "docs"))
    want = brute(docs)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("2k", "64m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            same(lm.score(spark.read.parquet(str(tmp_path / "docs")), chunk_bytes=2000).collect(), want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_sent_grow_with_the_input():
    def sent(count):
        generator = random.Random(3)
        level = []
        for p in range(count):
            words = [" ".join(f"w{generator.randrange(9000)}" for _ in range(500)).encode()]
            level += [row for kind, own in enumerate(lm.counted_keys(words, [True], [False])) for row in lm.ranged(p, kind, 4, *own)]
        rows, bits, target = 0, 4, lm.arrow_schema(lm.fields(lm.SENT))
        senders = count
        while True:
            rows += len(level)
            groups = -(-senders // 16)
            if groups <= 1:
                return rows
            met = {}
            for row in level:
                met.setdefault((row[2] * groups + hash(row[0]) % groups) * 2 + row[1], []).append(row)
            bits += 4
            level = []
            for to, own in met.items():
                group = lm.table_of(own, target).append_column("to", lm.pa.array([to] * len(own)))
                level += list(zip(*lm.handed_on(bits)(group).to_pydict().values()))
            senders = groups

    few, many = sent(32), sent(128)
    assert many <= 1.2 * 4 * few


def test_probabilities_add_up_to_one():
    mixture = lm.weights(np.array([0, 3, 3]), np.array([0.0, 0.5, 0.0]), np.array([0.1, 0.1, 0.0]), np.ones(3), 50)
    assert np.allclose(mixture.sum(axis=1), 1) and mixture[0, 0] == 0 and (mixture[:, 2] > 0).all()


def test_pack_round_trip():
    values = np.array([0, 1, 255, 256, 2**40, 2**56 - 1], "uint64")
    assert (lm.unpack(lm.pack(values)) == values).all() and len(lm.unpack(lm.pack(values[:0]))) == 0


def test_edges(spark, odd_docs, no_docs):
    same(lm.score(odd_docs).collect(), brute([(r["doc_id"], r["text"]) for r in odd_docs.collect()]))
    assert lm.score(no_docs).count() == 0
