import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, repeated rows, ties and columns with clashing names."""
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [
        (1, base, "en", "a", 1, "x", 1),
        (2, base, "en", "a", 1, "x", 2),
        (2, base, "en", "a", 1, "x", 2),
        (3, None, None, None, None, None, None),
        (4, "", "en", "a", 0, "x", 4),
        (None, base + " more", "de", "b", 1, "y", 5),
        (None, None, None, None, None, None, None),
        (5, "word " * 30_000, "de", "b", 1, "y", 6),
        (6, " \n\t ", "de", "b", 1, "y", 7),
        (7, "Ünïcode ТЕКСТ 漢字 — “quoted”, é İ", "de", "b", 1, "y", 8),
        (8, "all rights reserved\nLicensed under the Apache License, Version 2.0.", "en", "c", 50, "z", 9),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rep string, score long")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


def random_words(generator, count, vocabulary):
    return " ".join(generator.choice(vocabulary) for _ in range(count))
