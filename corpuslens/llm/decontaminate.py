"""Benchmark decontamination with one Aho-Corasick automaton over the item windows.

Every distinct item word is given one code point of its own, so that a text becomes a string with one
character per word (words that no item has share a filler), and an item window becomes a pattern of at most
13 characters. One scan of that string finds all windows; word numbers lead back to offsets in the text.

Items are small next to the corpus, but the number of their windows is checked: they are cut into passages that keep
every window whole, and passages into blocks of about ``block_windows`` windows, each with an automaton of its own. The documents
pass the blocks one after the other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import ALNUM_TABLE, alnum_words, arrow_schema, lean, slices, utf8
from corpuslens.sources.tables import materialize

WINDOW = 13
#: Windows of an automaton; each takes about a kilobyte.
BLOCK_WINDOWS = 200_000
#: Windows of a passage of an item.
PASSAGE_WINDOWS = 2_000
FILLER = "\x01"
#: Code points for item words: planes above the surrogates, one character per word.
FIRST_CODE, CODES = 0xE000, 0x110000 - 0xE000

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.LongType())),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)


class WindowAutomaton:
    """All windows of a block of items; ``hits`` gives word runs and the items behind them."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW, codes: int = CODES):
        worded = [(item, alnum_words(text)) for item, text in items]
        vocabulary: dict[bytes, int] = {}
        for _, words in worded:
            for word in words:
                vocabulary.setdefault(word, len(vocabulary))
        # beyond one code point per word: a high and a low character from disjoint halves of the range
        self.width = 1 if len(vocabulary) <= codes else 2
        half = codes // 2
        self.codes = {
            word: chr(FIRST_CODE + n) if self.width == 1 else chr(FIRST_CODE + n // half) + chr(FIRST_CODE + half + n % half)
            for word, n in vocabulary.items()
        }
        self.filler = FILLER * self.width
        patterns: dict[str, set[int]] = {}
        for item, words in worded:
            span = min(window, len(words))
            for first in range(len(words) - span + 1 if words else 0):
                patterns.setdefault("".join(self.codes[w] for w in words[first : first + span]), set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for pattern, owners in patterns.items():
            self.automaton.add_word(pattern, (len(pattern) // self.width, tuple(owners)))
        self.automaton.make_automaton()
        self.empty = not patterns

    def hits(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Merged runs ``[first, last]`` of hit words, in order, and the items whose windows occur."""
        runs: list[list[int]] = []
        owners: set[int] = set()
        if self.empty or not words:
            return runs, owners
        get, filler = self.codes.get, self.filler
        for end, (span, items) in self.automaton.iter("".join([get(w, filler) for w in words])):
            last = end // self.width
            first = last - span + 1
            owners.update(items)
            while runs and runs[-1][0] >= first:
                runs.pop()
            if runs and runs[-1][1] >= first - 1:
                runs[-1][1] = last
            else:
                runs.append([first, last])
        return runs, owners


def merged(runs: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def offsets(data: bytes, runs: list[list[int]]) -> list[dict]:
    """Character offsets in the original text of runs of words."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(ALNUM_TABLE))]
    spans, byte, char = [], 0, 0
    for first, last in runs:
        cut = {}
        for name, to in (("start", places[first][0]), ("end", places[last][1])):
            char += len(data[byte:to].decode("utf-8", "replace"))
            byte = to
            cut[name] = char
        spans.append(cut)
    return spans


def passages(items: DataFrame, window: int = WINDOW, size: int = PASSAGE_WINDOWS) -> DataFrame:
    """item_id, text, windows: items as overlapping passages of at most ``size`` windows, which together hold each window.

    Items without words have no passage; nulls are left out. Repeated items count once.
    """
    words = F.expr(r"regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)")
    worded = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", words.alias("words")).where("size(words) > 0").distinct()
    count = F.greatest(F.size("words") - (window - 1), F.lit(1))
    cut = worded.withColumn("windows", count).select("item_id", "words", "windows", F.explode(F.expr(f"sequence(0, windows - 1, {size})")).alias("first"))
    return cut.select("item_id", F.array_join(F.slice("words", F.col("first") + 1, size + window - 1), " ").alias("text"), F.least(F.col("windows") - F.col("first"), F.lit(size)).alias("windows"))


def scan(
    docs: DataFrame, items: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), into: str = "contamination",
    window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """The ``keep`` columns and a struct ``into``: n_words, n_hit, item_ids (sorted), spans (character offsets).

    One row for each input row, repeated rows too. Null or empty text has no words and no hits. Items with a
    null id or text, or without words, have no windows; an empty item table hits nothing. Other columns,
    whatever their names, are not read.
    """
    spark = docs.sparkSession
    usable = passages(items.select("item_id", "text"), window, min(PASSAGE_WINDOWS, block_windows))
    count = usable.agg(F.sum("windows")).first()[0] or 0
    blocks = -(-count // block_windows) or 1
    if blocks > 1:
        usable = materialize(usable, "passages")
    # a text that is kept goes to Python once
    source = text if text in keep else "__text"
    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias(source))
    carried = tuple(keep) if text in keep else (*keep, source)
    schema = T.StructType([rows.schema[c] for c in carried] + [T.StructField(into, RESULT), T.StructField("__runs", T.ArrayType(T.ArrayType(T.LongType())))])
    for block in range(blocks):
        part = usable.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        loaded = spark.sparkContext.broadcast([(r[0], r[1].encode()) for r in part.collect()])
        if block:
            rows = materialize(rows, "decontaminate")
        rows = rows.mapInArrow(lean(scanner(loaded, carried, source, into, window, block == blocks - 1, schema)), schema)
    return rows.select(*keep, into)


def scanner(loaded, carried: tuple[str, ...], source: str, into: str, window: int, last: bool, schema: T.StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = WindowAutomaton(loaded.value, window)
        target = arrow_schema(schema)
        for batch in slices(batches, source):
            before = batch.column(into).to_pylist() if into in batch.schema.names else None
            earlier = batch.column("__runs").to_pylist() if before is not None else None
            found, kept_runs = [], []
            for at, data in enumerate(utf8(batch.column(source))):
                words = alnum_words(data or b"")
                runs, owners = automaton.hits(words)
                if before is not None:
                    runs = merged(runs + earlier[at])
                    owners.update(before[at]["item_ids"])
                spans = offsets(data, runs) if runs and last else []
                found.append({"n_words": len(words), "n_hit": sum(b - a + 1 for a, b in runs), "item_ids": sorted(owners), "spans": spans})
                kept_runs.append([] if last else runs)
            columns = [batch.column(c).cast(target.field(c).type) for c in carried]
            if last and source == "__text":
                columns[-1] = pa.nulls(batch.num_rows, target.field(source).type)
            columns += [pa.array(found, target.field(into).type), pa.array(kept_runs, target.field("__runs").type)]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return run


def digest(scanned: DataFrame, key: str = "doc_id", into: str = "contamination") -> DataFrame:
    """Counts, a digest of the item ids and the verdict: contaminated if hits cover a twentieth of the words."""
    ids = F.array_sort(F.transform(F.col(f"{into}.item_ids"), lambda i: i.cast("string")))
    return scanned.select(
        key,
        F.col(f"{into}.n_words").alias("n_words"),
        F.col(f"{into}.n_hit").alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        contaminated(into).alias("contaminated"),
    )


def contaminated(into: str = "contamination"):
    return (F.col(f"{into}.n_hit") > 0) & (20 * F.col(f"{into}.n_hit") >= F.col(f"{into}.n_words"))
