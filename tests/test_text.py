"""Normaliser, decoding and tokenisers."""

import html
import random
import unicodedata

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.functions import tokens as tk
from corpuslens.functions import unicode as uni
from corpuslens.functions.stopwords import ENGLISH


def run(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r["o"] for r in df.select("i", expression(F.col("t")).alias("o")).orderBy("i").collect()]


def both_ways(spark, values):
    plain = run(spark, values, tx.normalize)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    staged = tx.with_normalized(df, {"t": "o"}).orderBy("i").collect()
    assert plain == [r["o"] for r in staged]
    return plain


def test_normalizer_examples(spark):
    wide = "ＣＡＦÉ News"
    out = both_ways(
        spark,
        [
            wide,
            "<p>Important <strong>report</strong></p>",
            "See https://example.com or editor@example.com",
            "This isn't true and can’t be verified.",
            None,
            " News ",
            "LONDON (Reuters) - A report was issued.",
            "a &amp; b &lt;i&gt; &frac12; &#8217;s",
            "snake_case, noooooo!! it's 5-4 <ok>",
        ],
    )
    assert out[0] == "caf" + chr(0xE9) + " news"
    assert out[1] == "important report"
    assert "urltoken" in out[2] and "emailtoken" in out[2] and "example.com" not in out[2]
    assert out[3] == "this is not true and can not be verified"
    assert out[4:6] == ["", "news"]
    assert out[6] == "a report was issued"
    assert out[7] == "a b " + chr(0xBD) + " s"
    assert out[8] == "snake case nooo!! it is 5-4"


def test_markers_and_adjacent_addresses(spark):
    out = both_ways(
        spark,
        [
            "said the Associated  Press; copyright 2017 all",
            "Reuters, reuterss and xreuters",
            "a@b.com-d@e.com",
            "HTTP://X.org/Y WwW.z.com",
        ],
    )
    assert out == [
        "said the all",
        "reuterss and xreuters",
        "emailtoken emailtoken",
        "urltoken urltoken",
    ]


def test_decode_matches_python_on_random_text(spark):
    rng = random.Random(1)
    alphabet = [chr(c) for c in (*range(32, 0x250), *range(0x300, 0x310), 0x2019, 0xFB01, 0x1100, 0x1161, 0xAC00, 0xFF21)]
    values = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    values += ["&eacute;&nbsp;x", "AT&T", "&#x41;", "fish & chips", "end "]

    def expected(v):
        v = unicodedata.normalize("NFKC", v).replace(chr(0x2019), "'").replace(chr(0x2018), "'")
        return html.unescape(v)

    assert run(spark, values, uni.decode) == [expected(v) for v in values]


def test_strip_and_word_count_follow_unicode_spaces(spark):
    values = ["  a\tb　", "\x1c\x1fx", "", "   ", "one  two"]
    assert run(spark, values, tx.strip) == [v.strip() for v in values]
    assert run(spark, values, tx.word_count) == [len(v.split()) for v in values]


def test_combine(spark):
    df = spark.createDataFrame([(" Title ", "Body"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(tx.combine(F.col("a"), F.col("b"))).collect()]
    assert got == ["Title bodytext Body", "bodytext"]


def test_model_tokens(spark):
    values = ["naïve can't -x rock- a straße 5th o'clock x-ray", "rock-ß"]
    got = run(spark, values, tk.model_tokens)
    assert got[0] == ["naive", "can't", "rock", "o'clock", "x-ray"]
    assert got[1] == ["rock-"]


def char_reference(text, low, high):
    grams = []
    for word in text.split():
        padded = f" {word} "
        for n in range(low, high + 1):
            if len(padded) < n:
                if n == low:
                    grams.append(padded)
                continue
            grams += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return sorted(grams)


def test_char_ngrams_match_definition(spark):
    values = ["a bb ccc dddd eeeee", "", "x", "\U00020000\U00020001 y z", "it is 'quoted' text"]
    for low, high in ((3, 5), (2, 3), (4, 6)):
        got = run(spark, values, lambda c, lo=low, hi=high: tk.char_ngrams(c, lo, hi))
        assert [sorted(g) for g in got] == [char_reference(v, low, high) for v in values]


def test_ngrams_and_stop_words(spark):
    df = spark.createDataFrame([(["the", "cat", "the", "sat"],), ([],)], "t array<string>")
    rows = df.select(
        tk.ngrams(F.col("t"), 2).alias("b"),
        tk.ngrams(F.col("t"), 3).alias("c"),
        tk.drop_stop_words(F.col("t"), ("the",)).alias("d"),
    ).collect()
    assert rows[0]["b"] == ["the cat", "cat the", "the sat"]
    assert rows[0]["c"] == ["the cat the", "cat the sat"] and rows[0]["d"] == ["cat", "sat"]
    assert rows[1]["b"] == [] and rows[1]["c"] == []


def test_packaged_stop_words_are_sparks(spark):
    assert sorted(ENGLISH) == sorted(StopWordsRemover.loadDefaultStopWords("english"))
