"""License scan: phrase places, and an exact set-similarity join of text lines with licence notices.

A line matches a template if it holds at least ``threshold`` of the template's distinct words. The join is
exact: template words are ordered by how many documents have them, rarest first. A line that matches must share
one of the first ``size - needed + 1`` words of that order (prefix filter), be long enough (length filter),
and have enough words left behind the first shared one on both sides (position filter). What passes is
counted in full. Only built-in DataFrame functions run.

``scan`` compares physical lines, as the check SQL of op9_license states it. ``scan_windows`` compares windows of
consecutive words across line ends, at most ``size / threshold`` words long for a template of ``size`` words, so a
wrapped notice is found whole and scattered words of a long line are not put together.

Templates are a parameter of a few dozen short notices; their words, frequencies and prefixes are the only things
collected and broadcast, and are bounded by ``MAX_TEMPLATE_WORDS``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
MAX_TEMPLATE_WORDS = 20_000

#: Phrases to place, as words, and their labels (fixed values).
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Notices to look for, with labels.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "this work has been dedicated to the public domain"),
    ("all-rights-reserved", "all rights reserved"),
)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def literal(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def prepared(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Key, lower-cased text and its words.

    Lower-casing letters beyond A-Z changes no word's borders, and makes an ASCII word of none once the Kelvin sign,
    whose small letter is k, is another letter.
    """
    lowered = F.lower(F.replace(F.coalesce(F.col(text), F.lit("")), F.lit("\u212a"), F.lit("\u0138")))
    base = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(key).alias("doc_id"), lowered.alias("lowered"))
    return base.withColumn("words", words(F.col("lowered")))


def document_frequency(rows: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """In how many rows each template word occurs; at most one number per word comes back."""
    found = rows.select(F.explode(F.array_intersect("words", literal(vocabulary))).alias("word")).groupBy("word").count()
    return {r["word"]: r["count"] for r in found.collect()}


def prefixes(rows: DataFrame, templates: tuple[tuple[str, str], ...], threshold: float) -> tuple[list[str], list[tuple]]:
    """Template words, rarest first, and the prefix words of every template:
    word, template, label, wanted, need, at, window."""
    sets = [(n, label, sorted(set(notice.split())), len(notice.split())) for n, (label, notice) in enumerate(templates)]
    vocabulary = sorted({w for _, _, ws, _ in sets for w in ws})
    if len(vocabulary) > MAX_TEMPLATE_WORDS:
        raise ValueError("templates have too many words to broadcast; scan them in parts")
    counts = document_frequency(rows, vocabulary)
    order = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: n for n, w in enumerate(order)}
    found = []
    for n, label, ws, size in sets:
        ws = sorted(ws, key=rank.__getitem__)
        need = math.ceil(threshold * len(ws) - 1e-9)
        window = math.ceil(size / threshold - 1e-9)
        found += [(w, n, label, ws, need, at + 1, window) for at, w in enumerate(ws[: len(ws) - need + 1])]
    return order, found


def inverted_words(inverted: list[tuple], order: list[str]) -> list[str]:
    return sorted({p[0] for p in inverted}, key=order.index)


INVERTED = "word string, template int, label string, wanted array<string>, need int, at int, window int"


def places(phrase: list[str]) -> Column:
    """Starts of a phrase in ``words``; rows without all of its words cost one look each."""
    here = F.col("words")
    present = F.lit(True)
    for word in phrase:
        present = present & F.array_contains(here, word)
    starts = F.filter(
        F.sequence(F.lit(0), F.size(here) - len(phrase)),
        lambda i: F.slice(here, i + 1, F.lit(len(phrase))) == literal(phrase),
    )
    return F.when(present & (F.size(here) >= len(phrase)), starts).otherwise(F.array().cast("array<int>"))


def phrase_places(phrases: dict[str, str]) -> tuple[Column, Column]:
    """Starts of all phrases, and the labels of those that occur."""
    starts = F.flatten(F.array(*[places(p.split()) for p in phrases]))
    named = F.array(*[F.when(F.size(places(p.split())) > 0, F.lit(label)) for p, label in phrases.items()])
    return starts, named


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``score`` is the largest containment of a template in a line, counted from the threshold up, and 1 where a
    phrase stands. Null and empty texts have no words, no labels and score 0; repeated rows give repeated
    results; an empty table gives an empty result. Other columns are not read.
    """
    rows = prepared(docs, key, text)
    order, inverted = prefixes(rows, templates, threshold)
    first_words = inverted_words(inverted, order)

    starts, named = phrase_places(phrases)
    lines = F.when(F.arrays_overlap("words", literal(first_words)), F.filter(F.split("lowered", "\n"), lambda line: line.rlike("|".join(first_words)))).otherwise(F.array().cast("array<string>"))
    scanned = rows.select(
        "row_no", "doc_id", F.size("words").cast("long").alias("n_words"), starts.alias("starts"), F.array_compact(named).alias("named"), lines.alias("lines"),
    )
    # every row keeps its first line slot, so that the rows without candidates stay; it alone takes the starts along
    blocks = scanned.select("row_no", "doc_id", "n_words", "starts", "named", F.posexplode_outer("lines").alias("slot", "line"))
    blocks = blocks.withColumn("starts", F.when(F.coalesce("slot", F.lit(0)) == 0, F.col("starts"))).withColumn("tokens", F.array_distinct(words(F.coalesce("line", F.lit("")))))
    ordered = F.array_intersect(literal(order), F.col("tokens"))  # keeps the order of the first: rarest first
    blocks = blocks.withColumn("ordered", F.when(F.size("tokens") > 0, ordered)).withColumn("word", F.explode_outer(F.array_intersect(literal(first_words), F.col("tokens"))))
    joined = blocks.join(F.broadcast(docs.sparkSession.createDataFrame(inverted, INVERTED)), "word", "left")
    left = F.least(F.size("wanted") - F.col("at"), F.size("ordered") - F.array_position("ordered", F.col("word")))
    passes = (F.size("tokens") >= F.col("need")) & (left + 1 >= F.col("need"))
    shared = F.when(passes, F.size(F.array_intersect("wanted", "tokens")))
    match = F.when(shared >= F.col("need"), F.struct(F.col("label"), (shared / F.size("wanted")).alias("part")))
    found = joined.select("row_no", "doc_id", "n_words", "starts", "named", match.alias("match"))
    return per_document(found)


def per_document(found: DataFrame) -> DataFrame:
    """One row per input row from its matches."""
    merged = found.groupBy("row_no").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.first("starts", True).alias("starts"), F.first("named").alias("named"),
        F.collect_set("match.label").alias("more"), F.max("match.part").alias("part"),
    )
    some = F.size("starts") > 0
    return merged.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("named")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("named", "more")), ",").alias("labels"),
        F.when(some, F.lit(1.0)).otherwise(F.coalesce("part", F.lit(0.0))).alias("score"),
    )


def scan_windows(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: dict[str, str] = PHRASES,
    threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """As ``scan``, but a template matches where ``size / threshold`` consecutive words of the document hold enough
    of its words, whether or not a line ends between them.

    A window that matches holds a prefix word, so only the words around prefix words are looked at, and all
    windows through such a place are counted in full once these words suffice.
    """
    rows = prepared(docs, key, text)
    order, inverted = prefixes(rows, templates, threshold)
    first_words = inverted_words(inverted, order)
    around = max(p[-1] for p in inverted) - 1
    starts, named = phrase_places(phrases)
    here, size = F.col("words"), F.size("words")
    at = F.when(
        F.arrays_overlap("words", literal(first_words)),
        F.filter(F.sequence(F.lit(1), size), lambda i: F.array_contains(literal(first_words), F.element_at(here, i))),
    ).otherwise(F.array().cast("array<int>"))
    # each place takes along the words that any window through it can have, and its own place among them
    near = F.transform(
        at,
        lambda i: F.struct(
            F.element_at(here, i).alias("word"),
            F.least(i, F.lit(around + 1)).alias("own"),
            F.slice(here, F.greatest(i - around, F.lit(1)), F.least(i, F.lit(around + 1)) + around).alias("tokens"),
        ),
    )
    scanned = rows.select("row_no", "doc_id", size.cast("long").alias("n_words"), starts.alias("starts"), F.array_compact(named).alias("named"), near.alias("near"))
    # rows without any place keep one slot, so that they stay; only the first slot takes the starts along
    blocks = scanned.select("row_no", "doc_id", "n_words", "starts", "named", F.posexplode_outer("near").alias("slot", "place"))
    blocks = blocks.withColumn("starts", F.when(F.coalesce("slot", F.lit(0)) == 0, F.col("starts"))).select("row_no", "doc_id", "n_words", "starts", "named", "place.*")
    joined = blocks.join(F.broadcast(docs.sparkSession.createDataFrame(inverted, INVERTED)), "word", "left")
    # taken as the first shared word of its window, the place needs the rest from the words behind it in the order
    behind = F.slice("wanted", F.col("at"), F.size("wanted") - F.col("at") + 1)
    passes = F.size(F.array_intersect(behind, F.col("tokens"))) >= F.col("need")
    windows = F.sequence(F.greatest(F.col("own") - F.col("window") + 1, F.lit(1)), F.col("own"))
    held = F.array_max(F.transform(windows, lambda i: F.size(F.array_intersect("wanted", F.slice("tokens", i, F.col("window"))))))
    shared = F.when(passes, held)
    match = F.when(shared >= F.col("need"), F.struct(F.col("label"), (shared / F.size("wanted")).alias("part")))
    return per_document(joined.select("row_no", "doc_id", "n_words", "starts", "named", match.alias("match")))
