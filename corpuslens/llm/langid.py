"""Language identification with interpolated Kneser-Ney character models in sorted hash arrays.

A text is read as its words: runs of letters and marks, lower-cased, each with a boundary before and behind it. A model of
order ``ORDER`` predicts every character of a word and its end from at most ``ORDER - 1`` characters before it, back to
the word's boundary and not beyond. So a word has one probability wherever it stands, and a batch scores its
distinct words only.

1. ``gram_counts``: every training text is counted. A row is one n-gram of full length, or from a word's start, per language.
2. ``build``: shorter n-grams count their distinct left neighbours; those at a word's start, which have none, count how
   often they occur. Each order subtracts its discount and passes the freed mass to the next shorter one, down to a
   uniform share for every known character and one unknown one. The driver does this for up to ``MODEL_EVENTS`` n-grams.
   ``stored`` does it for any number with one aggregate for each length and leaves the models in tables.
3. ``compare``: bits per event under every language. The least wins, ties go to the smaller name. Built models are broadcast.
   Of stored ones only the probabilities of the most frequent n-grams (``model_grams``) are. The others of a text are
   listed in its row, meet the tables length by length, and return by chunks of rows. Texts do not move. Both ways
   use every counted n-gram and agree.
4. ``calibrate``: a tenth of the training rows stays out of the counts. On them a logistic curve maps the winner's lead
   (bits over all events) to the chance of being right, and a high quantile of the winner's bits per event says which
   texts no language explains.

N-grams are told apart by 64 bits of a hash in arrays, by their codes in tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import arrow_schema, fields, fresh_name, slices
from corpuslens.llm.toxicity import logistic
from corpuslens.sources.tables import materialize

ORDER = 5
#: Models of up to so many n-grams, as counted over all languages, are built by the driver and broadcast.
MODEL_EVENTS = 600_000
SLICE = 4 << 20
#: N-grams listed in the rows of a chunk, and what a row counts beyond them.
CHUNK_GRAMS, LEAST_GRAMS = 1 << 18, 16
#: Probabilities broadcast, in multiples of the limit: with more languages fewer n-grams.
DENSE = 8
UNDETERMINED = "und"
#: A winner with a smaller chance of being right, or with more bits per event than this share of its
#: calibration texts, is rejected.
REJECT_BELOW, ENTROPY_QUANTILE = 0.5, 0.999

NOT_WORD = r"[^\p{L}\p{M}]+"
LETTER = r"\p{L}"
BOUNDARY = 32
_FACTOR, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)

RESULT = T.StructType(
    [
        T.StructField("best", T.StringType()),
        T.StructField("bits", T.DoubleType()),
        T.StructField("lead", T.DoubleType()),
        T.StructField("events", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Language:
    """Sorted hashes of n-grams with their discounted shares, and of contexts with the mass they pass on."""

    name: str
    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    passed: np.ndarray
    #: Mass that single characters pass on to the uniform share.
    rest: float


@dataclass(frozen=True)
class Tables:
    """Shares of n-grams and the mass that contexts pass on, by the length of the n-gram; maps by the language's number."""

    shares: dict[int, DataFrame]
    passed: dict[int, DataFrame]


@dataclass(frozen=True)
class Frequent:
    """Sorted hashes of n-grams and their probabilities, a column for each language."""

    keys: np.ndarray
    chances: np.ndarray


@dataclass(frozen=True)
class Identifier:
    order: int
    characters: int
    #: In the order of their names; without arrays if the models are in tables.
    languages: tuple[Language, ...]
    #: Logistic curve over the lead, and the most bits per event by language.
    curve: tuple[float, float] = (0.0, 0.0)
    limits: dict[str, float] = field(default_factory=dict)
    #: No chance is higher than the calibration rows can prove (rule of succession).
    ceiling: float = 0.5
    tables: Tables | None = None
    frequent: Frequent | None = None


# ---- words and n-grams --------------------------------------------------------------------------


@dataclass(frozen=True)
class Words:
    """Distinct words of a batch, and the row and word number of every place."""

    distinct: pa.Array
    row: np.ndarray
    word: np.ndarray


def words_of(texts: pa.Array) -> Words:
    """Lower-cased runs of letters and marks with at least one letter."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    lists = pc.split_pattern(pc.replace_substring_regex(texts, pattern=NOT_WORD, replacement=" "), pattern=" ")
    places = lists.flatten().dictionary_encode()
    known = pc.match_substring_regex(places.dictionary, pattern=LETTER).to_numpy(zero_copy_only=False)
    number = np.cumsum(known) - 1
    row = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    index = places.indices.to_numpy(zero_copy_only=False)
    kept = known[index] if len(known) else np.zeros(0, bool)
    return Words(places.dictionary.filter(pa.array(known)), row[kept], number[index[kept]])


@dataclass(frozen=True)
class Events:
    """Every character of some words and each word's end, with the length of the longest n-gram that ends there."""

    codes: np.ndarray
    at: np.ndarray
    word: np.ndarray
    length: np.ndarray


def events_of(distinct: pa.Array, order: int) -> Events:
    line = " " + " ".join(distinct.to_pylist()) + " "
    codes = np.frombuffer(line.encode("utf-32-le"), "<u4").astype("int64")
    at = np.arange(1, len(codes)) if len(distinct) else np.zeros(0, "int64")
    edge = codes == BOUNDARY
    before = np.maximum.accumulate(np.where(edge, np.arange(len(codes)), 0))
    return Events(codes, at, np.cumsum(edge)[at - 1] - 1, np.minimum(order, at - before[at - 1] + 1))


def gram_matrix(events: Events, order: int) -> np.ndarray:
    """Codes of the longest n-gram of each event, aligned to the right with zeros before it."""
    out = np.zeros((len(events.at), order), "int64")
    for back in range(order):
        inside = events.length > back
        out[inside, order - 1 - back] = events.codes[events.at[inside] - back]
    return out


def mix(value: np.ndarray, code: np.ndarray) -> np.ndarray:
    value = (value ^ (code.astype("uint64") + np.uint64(1))) * _FACTOR
    return value ^ (value >> _SHIFT)


def suffix_hashes(grams: np.ndarray) -> list[np.ndarray]:
    """Hash of the last k codes of every row, for k from 0."""
    out = [np.full(len(grams), np.uint64(grams.shape[1]))]
    for back in range(grams.shape[1]):
        out.append(mix(out[-1], grams[:, -1 - back]))
    return out


def row_keys(grams: np.ndarray) -> np.ndarray:
    return suffix_hashes(grams)[-1]


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, gram, n`` from ``lang, text``; a gram is ``order`` little-endian 32-bit codes, zeros first."""
    schema = fields("lang string, gram binary, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches, "text", SLICE):
            found = words_of(batch.column("text"))
            names = batch.column("lang").dictionary_encode()
            which = names.indices.to_numpy(zero_copy_only=False)[found.row]
            events = events_of(found.distinct, order)
            grams = gram_matrix(events, order)
            _, first, same = np.unique(row_keys(grams), return_index=True, return_inverse=True)
            grams = grams[first].astype("<u4")
            for number, name in enumerate(names.dictionary.to_pylist()):
                times = np.bincount(found.word[which == number], minlength=len(found.distinct))
                counts = np.bincount(same, times[events.word], len(first)).astype("int64")
                kept = np.flatnonzero(counts)
                flat = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(4 * order), len(kept), [None, pa.py_buffer(np.ascontiguousarray(grams[kept]))]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(kept), pa.string()), flat.cast(pa.binary()), pa.array(counts[kept])], schema=target
                )

    counted = rows.mapInArrow(run, schema)
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model_grams(counts: DataFrame, limit: int = MODEL_EVENTS) -> DataFrame:
    """The most frequent n-grams of each language, about ``limit`` of all.

    Each language gets the same number. Counts from 1024 on share a step of a sixty-fourth octave; of the step in which a
    language's share ends, a hash picks the part that fits.
    """
    languages = max(1, counts.select("lang").distinct().count())
    quota = max(1, limit // languages)
    n = F.col("n")
    step = F.when(n < 1024, n).otherwise(1024 + F.floor(64 * F.log2(n / 1024))).cast("long")
    stepped = counts.withColumn("step", step)
    sizes = stepped.groupBy("lang", "step").agg(F.count("*").alias("size"))
    # a few thousand steps for each language
    down = Window.partitionBy("lang").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    before = F.sum("size").over(down) - F.col("size")
    shares = sizes.select("lang", "step", ((quota - before) / F.col("size")).alias("share")).where("share > 0")
    place = F.pmod(F.xxhash64("gram"), F.lit(1 << 30)) / float(1 << 30)
    return stepped.join(shares, ["lang", "step"]).where(place < F.col("share")).select("lang", "gram", "n")


# ---- the models ---------------------------------------------------------------------------------


def discount(adjusted: np.ndarray) -> float:
    """Ney's estimate from the n-grams with counts 1 and 2."""
    one, two = (adjusted == 1).sum(), (adjusted == 2).sum()
    return float(one / (one + 2 * two)) if one and two else 0.5


def language(name: str, grams: np.ndarray, counts: np.ndarray) -> Language:
    """Kneser-Ney shares of the n-grams of all lengths, from those of full length or from a word's start."""
    order = grams.shape[1]
    lengths = (grams != 0).sum(axis=1)
    longer, keys, shares, contexts, passed, rest = grams[:0], [], [], [], [], 1.0
    for k in range(order, 0, -1):
        own = lengths == k
        # what precedes decides nothing about a shorter n-gram but that it is another neighbour
        shorter = longer.copy()
        shorter[:, order - 1 - k : order - k] = 0
        level = np.concatenate([grams[own], shorter]) if k < order else grams[own]
        weight = np.concatenate([counts[own].astype("float64"), np.ones(len(shorter))]) if k < order else counts[own].astype("float64")
        key, first, same = np.unique(row_keys(level[:, order - k :]), return_index=True, return_inverse=True)
        level, adjusted = level[first], np.bincount(same, weight, len(key))
        longer = level
        if not len(key):
            continue
        cut = discount(adjusted)
        context, owner = np.unique(row_keys_of(level, order, k), return_inverse=True)
        total, kinds = np.bincount(owner, adjusted), np.bincount(owner)
        keys.append(suffix_hashes(level)[k])
        # counts are 1 at least and the discount is less
        shares.append((adjusted - cut) / total[owner])
        if k > 1:
            contexts.append(context)
            passed.append(cut * kinds / total)
        else:
            rest = float(cut * kinds[0] / total[0])
    return Language(name, *in_order(keys, shares), *in_order(contexts, passed), rest)


def row_keys_of(level: np.ndarray, order: int, k: int) -> np.ndarray:
    """Hash of each n-gram of length k without its last code."""
    shifted = np.zeros_like(level)
    shifted[:, 1:] = level[:, :-1]
    return suffix_hashes(shifted)[k - 1]


def in_order(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, "uint64"), np.zeros(0)
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key)
    return key[order], value[order]


def build(names: list[str], grams: np.ndarray, counts: np.ndarray, order: int = ORDER) -> Identifier:
    """Models of all languages from rows (name, codes, count)."""
    which = np.array(names, dtype=object)
    known = len(np.unique(grams[:, -1])) if len(grams) else 0
    found = sorted(set(names))
    return Identifier(order, known, tuple(language(name, grams[which == name], counts[which == name]) for name in found))


def by_language(rows: DataFrame, key: str, into: str) -> DataFrame:
    """``key`` and a map of ``value`` by ``number`` from rows of one language each."""
    return rows.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("number", "value"))).alias(into))


def without_zeros(order: int) -> Column:
    used = sum((F.substring("gram", 4 * i + 1, 4) != F.expr("X'00000000'")).cast("int") for i in range(order))
    return F.col("gram").substr(4 * (order - used) + 1, 4 * used).alias("gram")


def stored(counts: DataFrame, order: int = ORDER, limit: int = MODEL_EVENTS) -> Identifier:
    """The models that ``build`` makes, from ``lang, gram, n`` of any size and left in tables. N-grams lose their zeros there.

    The probabilities of about ``limit`` n-grams are looked up for the driver.
    """
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    number = F.create_map(*[F.lit(x) for n, name in enumerate(names) for x in (name, n)])[F.col("lang")]
    own = counts.select(number.alias("number"), without_zeros(order), F.col("n").alias("times"))
    longer, shares, passed = None, {}, {}
    for k in range(order, 0, -1):
        rows = own.where(F.octet_length("gram") == 4 * k)
        if longer is not None:
            rows = rows.union(longer.select("number", F.substring("gram", 5, 4 * k), F.lit(1).cast("long")))
        longer = materialize(rows.groupBy("number", "gram").agg(F.sum("times").alias("times")), f"langid-level{k}")
        one, two = F.count_if(F.col("times") == 1), F.count_if(F.col("times") == 2)
        cuts = longer.groupBy("number").agg(F.when((one > 0) & (two > 0), one / (one + 2 * two)).otherwise(0.5).alias("cut"))
        level = longer.join(F.broadcast(cuts), "number").withColumn("context", F.substring("gram", 1, 4 * (k - 1)))
        # as many rows as there are characters, at most
        total = F.sum("times").over(Window.partitionBy("number", "context"))
        share = level.select("number", "gram", ((F.col("times") - F.col("cut")) / total).alias("value"))
        shares[k] = materialize(by_language(share, "gram", "shares"), f"langid-shares{k}")
        freed = level.groupBy("number", "context").agg((F.first("cut") * F.count("*") / F.sum("times")).alias("value"))
        passed[k] = materialize(by_language(freed, "context", "passed"), f"langid-passed{k}")
    rest = passed.pop(1).first()["passed"]
    none = np.zeros(0, "uint64"), np.zeros(0)
    found = tuple(Language(name, *none, *none, rest[n]) for n, name in enumerate(names))
    model = Identifier(order, shares[1].count(), found, tables=Tables(shares, passed))
    grams = model_grams(counts, max(1, limit * DENSE // max(DENSE, len(names)))).select(without_zeros(order)).distinct()
    grams = materialize(grams, "langid-frequent")
    known = stored_probabilities(model, grams).join(grams, "gram", "left_semi").toArrow()
    codes = b"".join(g.rjust(4 * order, bytes(1)) for g in known.column("gram").to_pylist())
    keys = row_keys(np.frombuffer(codes, "<u4").reshape(-1, order).astype("int64"))
    at = np.argsort(keys)
    return replace(model, frequent=Frequent(keys[at], numbers(known.column("chances"), len(names))[at]))


def numbers(lists: pa.ChunkedArray, width: int) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy().reshape(-1, width)


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, otherwise: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), otherwise)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], otherwise)


def probabilities(model: Identifier, grams: np.ndarray) -> np.ndarray:
    """Probability of the last code of each row after those before it, a column for each language."""
    order = model.order
    lengths = (grams != 0).sum(axis=1)
    ends = suffix_hashes(grams)
    shifted = np.zeros_like(grams)
    shifted[:, 1:] = grams[:, :-1]
    contexts = suffix_hashes(shifted)
    out = np.empty((len(grams), len(model.languages)))
    for column, one in enumerate(model.languages):
        p = np.full(len(grams), one.rest / (model.characters + 1))
        p += looked_up(one.grams, one.shares, ends[1], 0.0)
        for k in range(2, order + 1):
            inside = np.flatnonzero(lengths >= k)
            passed = looked_up(one.contexts, one.passed, contexts[k - 1][inside], 1.0)
            p[inside] = passed * p[inside] + looked_up(one.grams, one.shares, ends[k][inside], 0.0)
        out[:, column] = p
    return out


def stored_probabilities(model: Identifier, wanted: DataFrame) -> DataFrame:
    """``gram, chances``: what ``probabilities`` gives, for the distinct n-grams in ``wanted`` and their ends."""
    start = F.array(*[F.lit(one.rest / (model.characters + 1)) for one in model.languages])
    shorter, out = None, None
    for k in range(1, model.order + 1):
        asked = wanted.where(F.octet_length("gram") >= 4 * k).select(F.substring("gram", -4 * k, 4 * k).alias("gram")).distinct()
        met = asked.join(model.tables.shares[k], "gram", "left")
        if shorter is None:
            met = met.select("gram", "shares", F.expr("CAST(NULL AS map<int,double>)").alias("passed"), start.alias("below"))
        else:
            met = met.withColumns({"context": F.substring("gram", 1, 4 * (k - 1)), "end": F.substring("gram", 5, 4 * (k - 1))})
            met = met.join(model.tables.passed[k], "context", "left")
            met = met.join(shorter.select(F.col("gram").alias("end"), F.col("chances").alias("below")), "end")
        chances = F.expr(
            f"transform(sequence(0, {len(model.languages) - 1}), i -> "
            "coalesce(try_element_at(passed, i), 1D) * below[i] + coalesce(try_element_at(shares, i), 0D))"
        )
        shorter = materialize(met.select("gram", chances.alias("chances")), f"langid-chances{k}")
        out = shorter if out is None else out.union(shorter)
    return out


def word_bits(model: Identifier, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bits of every word under every language, and its number of events."""
    events = events_of(distinct, model.order)
    grams = gram_matrix(events, model.order)
    _, first, same = np.unique(row_keys(grams), return_index=True, return_inverse=True)
    bits = -np.log2(probabilities(model, grams[first]))
    sums = [np.bincount(events.word, column[same], len(distinct)) for column in bits.T]
    return np.stack(sums, axis=1) if sums else np.zeros((len(distinct), 0)), np.bincount(events.word, minlength=len(distinct))


def measured(model: Identifier, texts: pa.Array) -> pa.StructArray:
    """``RESULT`` of every text."""
    found = words_of(texts)
    bits, lengths = word_bits(model, found.distinct)
    events = np.bincount(found.row, lengths[found.word], len(texts)).astype("int64")
    return decided(model, text_bits(found, bits, len(texts)), events)


def text_bits(found: Words, bits: np.ndarray, texts: int) -> np.ndarray:
    totals = np.zeros((texts, bits.shape[1]))
    for column in range(bits.shape[1]):
        totals[:, column] = np.bincount(found.row, bits[found.word, column], texts)
    return totals


def decided(model: Identifier, totals: np.ndarray, events: np.ndarray) -> pa.StructArray:
    """``RESULT`` from the bits of texts under every language."""
    none = (events == 0) | (len(model.languages) == 0)
    if len(model.languages):
        best = totals.argmin(axis=1)
        ranked = np.partition(totals, 1, axis=1) if totals.shape[1] > 1 else np.column_stack([totals, totals])
        least, lead = ranked[:, 0], ranked[:, 1] - ranked[:, 0]
    else:
        best, least, lead = np.zeros(len(totals), int), np.zeros(len(totals)), np.zeros(len(totals))
    names = np.array([one.name for one in model.languages] or [""], dtype=object)[best]
    columns = [
        pa.array(names, pa.string(), mask=none), pa.array(least / np.maximum(events, 1), mask=none),
        pa.array(lead, mask=none), pa.array(events),
    ]
    return pa.StructArray.from_arrays(columns, names=RESULT.names)


@dataclass(frozen=True)
class Partial:
    """Bits of texts by their frequent n-grams, their events, and the number of each other n-gram in each text."""

    totals: np.ndarray
    events: np.ndarray
    row: np.ndarray
    gram: pa.Array
    times: np.ndarray


def partly_measured(frequent: Frequent, texts: pa.Array, order: int) -> Partial:
    found = words_of(texts)
    events = events_of(found.distinct, order)
    grams = gram_matrix(events, order)
    keys, first, same = np.unique(row_keys(grams), return_index=True, return_inverse=True)
    at = np.searchsorted(frequent.keys, keys)
    known = at < len(frequent.keys)
    known[known] = frequent.keys[at[known]] == keys[known]
    bits = np.zeros((len(keys), frequent.chances.shape[1]))
    bits[known] = -np.log2(frequent.chances[at[known]])
    words = len(found.distinct)
    of_words = np.stack([np.bincount(events.word, column[same], words) for column in bits.T], axis=1)
    lengths = np.bincount(events.word, minlength=words)
    # events stand in the order of their words
    rare = np.flatnonzero(~known[same])
    each = np.bincount(events.word[rare], minlength=words)
    size = each[found.word]
    row, start = np.repeat(found.row, size), np.repeat((np.cumsum(each) - each)[found.word] - (np.cumsum(size) - size), size)
    pairs, times = np.unique(row * len(keys) + same[rare][start + np.arange(len(row))], return_counts=True)
    codes = grams[first].astype("<u4")
    ends = np.concatenate([[0], 4 * np.cumsum((codes != 0).sum(axis=1))]).astype("<i4")
    spelled = pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes[codes != 0])])
    return Partial(
        text_bits(found, of_words, len(texts)), np.bincount(found.row, lengths[found.word], len(texts)).astype("int64"),
        pairs // max(1, len(keys)), spelled.take(pa.array(pairs % max(1, len(keys)))), times,
    )


# ---- fitting and scoring ------------------------------------------------------------------------


def compare(docs: DataFrame, model: Identifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",), into: str = "language") -> DataFrame:
    """The ``keep`` columns and a struct ``into``: best, bits per event, lead in bits, events."""
    if model.tables is not None:
        return compare_stored(docs, model, text, keep, into)
    column = fresh_name("text", list(keep))
    rows = docs.select(*keep, F.col(text).alias(column))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(into, RESULT)])
    loaded = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(schema)
        for batch in slices(batches, column, SLICE):
            found = measured(loaded.value, batch.column(column)).cast(target.field(into).type)
            columns = [batch.column(c).cast(target.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, found], schema=target)

    return rows.mapInArrow(run, schema)


def compare_stored(docs: DataFrame, model: Identifier, text: str, keep: tuple[str, ...], into: str) -> DataFrame:
    """``compare`` by models in tables. What the frequent n-grams leave open is written, so that a repeated task finds the same chunks."""
    rows = docs.select(*[F.col(c).alias(f"keep{n}") for n, c in enumerate(keep)], F.col(text).alias("text"))
    kept = rows.schema.fields[:-1]
    lists = {"totals": T.DoubleType(), "rare": T.BinaryType(), "times": T.LongType()}
    listed = T.StructType([*kept, *fields("p long, events long"), *[T.StructField(c, T.ArrayType(t)) for c, t in lists.items()]])
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(keep, kept)] + [T.StructField(into, RESULT)])
    names, languages = replace(model, tables=None, frequent=None), len(model.languages)
    loaded = docs.sparkSession.sparkContext.broadcast(model.frequent)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(listed)
        task, size = TaskContext.get().partitionId() << 32, 0
        for batch in slices(batches, "text", SLICE):
            part = partly_measured(loaded.value, batch.column("text"), names.order)
            own = np.bincount(part.row, minlength=batch.num_rows)
            ends = np.concatenate([[0], np.cumsum(own)]).astype("int32")
            chunk = task + (size + np.cumsum(own + LEAST_GRAMS) - own - LEAST_GRAMS) // CHUNK_GRAMS
            size += int(own.sum()) + LEAST_GRAMS * batch.num_rows
            bits = pa.ListArray.from_arrays(np.arange(0, part.totals.size + 1, languages, dtype="int32"), part.totals.ravel())
            columns = [
                *(batch.column(f.name) for f in kept), pa.array(chunk), pa.array(part.events), bits,
                pa.ListArray.from_arrays(ends, part.gram), pa.ListArray.from_arrays(ends, pa.array(part.times)),
            ]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, target)], schema=target)

    def rest(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        target = arrow_schema(schema)
        totals = numbers(chunk.column("totals"), languages).copy()
        rare, times = (chunk.column(c).combine_chunks() for c in ("rare", "times"))
        row = np.repeat(np.arange(len(rare)), pc.list_value_length(rare).to_numpy())
        at = pc.index_in(rare.flatten(), value_set=answers.column("gram").combine_chunks())
        if at.null_count:
            raise RuntimeError("a chunk's answers do not fit its texts")
        bits, at = -np.log2(numbers(answers.column("chances"), languages)), at.to_numpy()
        for column in range(languages):
            totals[:, column] += np.bincount(row, bits[at, column] * times.flatten().to_numpy(), len(totals))
        found = decided(names, totals, chunk.column("events").to_numpy()).cast(target.field(into).type)
        columns = [chunk.column(f.name).cast(target.field(c).type) for c, f in zip(keep, kept)]
        return pa.Table.from_arrays([*columns, found], schema=target)

    begun = materialize(rows.mapInArrow(first, listed), "langid-begun")
    wanted = materialize(begun.select("p", F.explode("rare").alias("gram")).distinct(), "langid-wanted")
    answers = wanted.join(stored_probabilities(model, wanted.select("gram")), "gram")
    return begun.groupBy("p").cogroup(answers.groupBy("p")).applyInArrow(rest, schema)


def evidence(lead: Column) -> Column:
    return F.log2(1 + lead)


def calibrate(model: Identifier, rows: DataFrame) -> Identifier:
    """Fit the curve and the limits on rows ``lang, text`` that were not counted.

    Rows are added up in steps of the evidence. A text without evidence is taken to be right once in as many
    languages as there are, which also keeps the curve finite where nothing goes wrong.
    """
    found = compare(rows, model, keep=("lang",)).where("language.best IS NOT NULL").select("lang", "language.*")
    found = materialize(found, "langid-calibration")
    step = F.floor(evidence(F.col("lead")) * 8)
    lines = found.groupBy(step.alias("step"), (F.col("lang") == F.col("best")).alias("right")).agg(F.count("*").alias("n")).collect()
    number = max(2, len(model.languages))
    x = np.array([0.0, 0.0, *[(r["step"] + 0.5) / 8 for r in lines]])
    truth = np.array([1.0, 0.0, *[float(r["right"]) for r in lines]])
    weight = np.array([1.0, number - 1.0, *[float(r["n"]) for r in lines]])
    offset, slope = logistic(np.column_stack([np.ones(len(x)), x]), truth, weight, ridge=1.0)
    rows_seen = sum(r["n"] for r in lines)
    limits = found.groupBy("best").agg(F.percentile_approx("bits", ENTROPY_QUANTILE, 10_000).alias("limit")).collect()
    return replace(
        model, curve=(float(offset), max(0.0, float(slope))), limits={r["best"]: r["limit"] for r in limits},
        ceiling=(rows_seen + 1) / (rows_seen + 2),
    )


def train(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", *, folds: int = 3, held: int = 1,
    order: int = ORDER, limit: int = MODEL_EVENTS,
) -> Identifier:
    """Fit on all rows with a language whose fold, the CRC-32 of the id modulo ``folds``, is not ``held``.

    A tenth of them (by the rest of the same CRC) calibrates; the others are counted. Rows with a null language teach
    nothing, a null text has no words, and each repeated row counts. Without any row the model knows no language.
    Every n-gram counts; ``limit`` only says up to how many the driver builds the models.
    """
    code = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    rows = docs.where(F.col(lang).isNotNull() & (code % folds != held)).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"), (F.floor(code / folds) % 10 == 0).alias("apart")
    )
    counts = materialize(gram_counts(rows.where("NOT apart").select("lang", "text"), order), "langid-grams")
    if counts.count() > limit:
        model = stored(counts, order, limit)
    else:
        table = counts.toArrow().sort_by([("lang", "ascending"), ("gram", "ascending")])
        grams = np.frombuffer(b"".join(table.column("gram").to_pylist()), "<u4").reshape(-1, order).astype("int64")
        model = build(table.column("lang").to_pylist(), grams, table.column("n").to_numpy(), order)
    return calibrate(model, rows.where("apart").select("lang", "text"))


def identify(docs: DataFrame, model: Identifier, text: str = "text", keep: tuple[str, ...] = ("doc_id",), into: str = "language") -> DataFrame:
    """The ``keep`` columns and a struct ``into``: lang, best, score, rejected, bits, events.

    ``best`` is the language with the fewest bits per event, null for a null text or one without a letter; ``score``
    is its chance of being right (0 without a best one). ``lang`` is ``best``, or ``und`` where there is none or it
    is rejected: too small a chance, or more bits per event than nearly all calibration texts of that language.
    Only the text decides; one row per input row.
    """
    rows = compare(docs, model, text, keep, into)
    name = F.col(f"{into}.best")
    offset, slope = model.curve
    chance = F.coalesce(model.ceiling / (1 + F.exp(-(offset + slope * evidence(F.col(f"{into}.lead"))))), F.lit(0.0))
    limits = F.create_map(*[F.lit(x) for pair in model.limits.items() for x in pair]) if model.limits else F.create_map().cast("map<string,double>")
    strange = F.coalesce(F.col(f"{into}.bits") > limits[F.coalesce(name, F.lit(""))], F.lit(False))
    rejected = name.isNull() | (chance < REJECT_BELOW) | strange
    made = F.struct(
        F.when(rejected, UNDETERMINED).otherwise(name).alias("lang"), name.alias("best"), chance.alias("score"),
        rejected.alias("rejected"), F.col(f"{into}.bits").alias("bits"), F.col(f"{into}.events").alias("events"),
    )
    return rows.select(*keep, made.alias(into))
