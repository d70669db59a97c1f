import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from corpuslens.llm import langid
from corpuslens.llm.queries import QUERIES


def split(text):
    kept = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return [w for w in kept.split(" ") if any(unicodedata.category(c)[0] == "L" for c in w)]


def grams_of(text, order):
    for word in split(text):
        line = f" {word} "
        for end in range(2, len(line) + 1):
            yield line[max(0, end - order) : end]


class Brute:
    """Interpolated Kneser-Ney by dictionaries of strings."""

    def __init__(self, counts, order, characters):
        self.order, self.characters, self.levels = order, characters, {}
        longer = {}
        for k in range(order, 0, -1):
            level = {g: n for g, n in counts.items() if len(g) == k}
            for g in longer:
                level[g[1:]] = level.get(g[1:], 0) + 1
            values = Counter(level.values())
            cut = values[1] / (values[1] + 2 * values[2]) if values[1] and values[2] else 0.5
            totals, kinds = defaultdict(float), Counter()
            for g, n in level.items():
                totals[g[:-1]] += n
                kinds[g[:-1]] += 1
            self.levels[k] = level, cut, totals, kinds
            longer = level

    def p(self, gram):
        if not gram:
            return 1 / (self.characters + 1)
        level, cut, totals, kinds = self.levels[len(gram)]
        if gram[:-1] not in totals:
            return self.p(gram[1:])
        total = totals[gram[:-1]]
        return max(level.get(gram, 0) - cut, 0) / total + cut * kinds[gram[:-1]] / total * self.p(gram[1:])


def samples(count=240):
    generator = random.Random(5)
    syllables = {"aa": ["ka", "lo", "mi", "tu", "é"], "bb": ["sch", "en", "ung", "ö", "t"], "cc": ["ый", "ко", "не", "t"]}
    rows = []
    for n in range(count):
        name = generator.choice(sorted(syllables))
        words = ["".join(generator.choice(syllables[name]) for _ in range(generator.randrange(1, 5))) for _ in range(generator.randrange(1, 30))]
        rows.append((n, " ".join(words).capitalize() + ".\n7x " + words[0], name))
    return rows


def fold(key):
    return zlib.crc32(("" if key is None else str(key)).encode())


def test_matches_brute_force(spark):
    rows = samples()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    counts = defaultdict(Counter)
    for i, text, name in rows:
        if fold(i) % 3 != 1 and fold(i) // 3 % 10:
            counts[name].update(grams_of(text, langid.ORDER))
    characters = len({g[-1] for c in counts.values() for g in c})
    brute = {name: Brute(c, langid.ORDER, characters) for name, c in counts.items()}
    got = {r["doc_id"]: r["language"] for r in langid.compare(docs, langid.train(docs)).collect()}
    for i, text, _ in rows:
        events = list(grams_of(text, langid.ORDER))
        bits = {name: -sum(math.log2(b.p(g)) for g in events) for name, b in brute.items()}
        best = min(bits, key=lambda k: (bits[k], k))
        lead = sorted(bits.values())[1] - bits[best]
        assert got[i]["best"] == best and got[i]["events"] == len(events)
        assert math.isclose(got[i]["bits"], bits[best] / len(events), rel_tol=1e-9)
        assert math.isclose(got[i]["lead"], lead, rel_tol=1e-7, abs_tol=1e-7)


def test_more_grams_than_the_driver_builds_lose_nothing(spark, odd_docs, monkeypatch):
    monkeypatch.setattr(langid, "CHUNK_GRAMS", 500)
    docs = spark.createDataFrame(samples(), "doc_id long, text string, lang string").repartition(3)
    for rows, keep in ((docs, ("doc_id",)), (odd_docs, ("doc_id", "text", "rep", "score"))):
        whole, large = langid.train(rows), langid.train(rows, limit=5)
        assert whole.tables is None and large.tables is not None and large.characters == whole.characters
        assert math.isclose(large.ceiling, whole.ceiling) and np.allclose(large.curve, whole.curve)
        expected, got = (
            sorted(langid.identify(rows, m, keep=keep).collect(), key=lambda r: str(r[: len(keep)])) for m in (whole, large)
        )
        assert [r[: len(keep)] for r in got] == [r[: len(keep)] for r in expected]
        for a, b in zip(got, expected):
            a, b = a["language"], b["language"]
            assert (a["lang"], a["best"], a["rejected"], a["events"]) == (b["lang"], b["best"], b["rejected"], b["events"])
            assert math.isclose(a["score"], b["score"], rel_tol=1e-9) and (a["bits"] is None) == (b["bits"] is None)
            assert a["bits"] is None or math.isclose(a["bits"], b["bits"], rel_tol=1e-12)


def test_large_models_match_brute_force(spark, monkeypatch):
    large = langid.train
    monkeypatch.setattr(langid, "train", lambda docs: large(docs, limit=300))
    test_matches_brute_force(spark)


def test_rows_list_what_is_not_frequent():
    texts = ["Été eau eau", None, "", "l'eau 12 abcdefg abcdefg", "x"]
    every = sorted({g for text in texts for g in grams_of(text, langid.ORDER)})
    codes = np.array([[0] * (langid.ORDER - len(g)) + [ord(c) for c in g] for g in every], "int64")
    for share in (0, 5, len(every)):
        keys = np.sort(langid.row_keys(codes[:share]))
        part = langid.partly_measured(langid.Frequent(keys, np.full((share, 2), 0.25)), pa.array(texts), langid.ORDER)
        listed = Counter(zip(part.row.tolist(), (g.decode("utf-32-le") for g in part.gram.to_pylist())))
        assert set(listed.values()) <= {1}
        got = {pair: n for pair, n in zip(listed, part.times.tolist())}
        whole = Counter((n, g) for n, text in enumerate(texts) for g in grams_of(text, langid.ORDER))
        assert got == {pair: n for pair, n in whole.items() if pair[1] not in every[:share]}
        assert part.totals.tolist() == [[2.0 * sum(n for (r, g), n in whole.items() if r == row and g in every[:share])] * 2 for row in range(len(texts))]
        assert part.events.tolist() == [sum(n for (r, _), n in whole.items() if r == row) for row in range(len(texts))]


def test_no_language_is_cut_to_its_share(spark):
    rows = [(n, " ".join(f"{a}{b}{c}" for a in "abcdefg" for b in "hijklm" for c in "nopq"), "many") for n in range(1, 40)]
    rows += [(n, "zu", "few") for n in range(40, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, limit=400)
    lengths = {one.name: len(one.grams) for one in model.languages}
    assert lengths["many"] == len({g[-k:] for g in grams_of(rows[0][1], langid.ORDER) for k in range(1, len(g) + 1)})
    assert model.tables is None


def test_probabilities_add_up_to_one():
    generator = np.random.default_rng(1)
    words = ["".join(generator.choice(list("abcö"), generator.integers(1, 7))) for _ in range(80)]
    counts = Counter(g for w in words for g in grams_of(w, 4))
    codes = np.array([[0] * (4 - len(g)) + [ord(c) for c in g] for g in counts], "int64")
    model = langid.build(["x"] * len(codes), codes, np.array(list(counts.values())), 4)
    every = [ord(c) for c in "abcö "] + [0x4E2D]  # the last stands for the one unknown character
    for context in ("", " ", " a", "bc", "abc", " öö", "cab", "zzz"):
        rows = np.array([[0] * (3 - len(context)) + [ord(c) for c in context] + [c] for c in every], "int64")
        assert np.isclose(langid.probabilities(model, rows).sum(), 1.0), context


def test_words():
    found = langid.words_of(pa.array(["Été, l'eau\n2x", None, "", "12 ¿?", "नमस्ते ÉTÉ", "́ a"]))
    words = found.distinct.to_pylist()
    assert [(r, words[w]) for r, w in zip(found.row, found.word)] == [
        (0, "été"), (0, "l"), (0, "eau"), (0, "x"), (4, "नमस्ते"), (4, "été"), (5, "a"),
    ]
    assert len(langid.words_of(pa.array([], pa.string())).row) == 0


def test_grams_are_cut_by_count(spark):
    rows = [("a", bytes([n, 0, 0, 0]), n) for n in range(1, 101)] + [("b", bytes([n, 0, 0, 0]), 1) for n in range(100)]
    counts = spark.createDataFrame(rows, "lang string, gram binary, n long")
    kept = langid.model_grams(counts, 40).collect()
    assert sorted(r["n"] for r in kept if r["lang"] == "a") == list(range(81, 101))
    assert 5 <= sum(r["lang"] == "b" for r in kept) <= 40
    assert langid.model_grams(counts, 1000).count() == 200


def test_held_out_accuracy_and_rejection(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in QUERIES["op12_language"](spark, small).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.95 * len(held)
    model = langid.train(docs)
    strange = spark.createDataFrame([(1, "жщ" * 200), (2, "the and thing of")], "doc_id long, text string")
    rows = {r["doc_id"]: r["language"] for r in langid.identify(strange, model).collect()}
    assert rows[1]["rejected"] and rows[1]["lang"] == "und" and rows[1]["best"] in ("de", "en", "es", "fr")
    assert rows[2]["best"] == "en" and 0.5 < rows[2]["score"] < 1


def test_edges(spark, odd_docs, no_docs):
    model = langid.train(odd_docs)
    rows = langid.identify(odd_docs, model, keep=("doc_id", "text", "score", "rep")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letters = bool(re.search(r"[^\W\d_]", r["text"] or ""))
        assert (r["language"]["best"] is not None) == letters
        assert 0 <= r["language"]["score"] <= 1
        if not letters:
            assert r["language"]["lang"] == "und" and r["language"]["score"] == 0 and r["language"]["rejected"]
    empty = langid.train(no_docs)
    assert empty.languages == () and langid.identify(no_docs, model).count() == 0
    assert {r["language"]["lang"] for r in langid.identify(odd_docs, empty).collect()} == {"und"}
