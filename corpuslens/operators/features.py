"""TF-IDF features: vocabulary, sparse vectors and the long table.

Statistics need one exchange per space (terms with totals and document counts), of terms that each task has
counted run by run. Everything per document stays in its row: words, counts and weights come from one vectorised Arrow
function, which cuts each distinct word of a run once. No shuffle by document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.config import FeatureOptions
from corpuslens.functions import grams, sparse
from corpuslens.functions import tokens as tk
from corpuslens.functions.model_words import ModelWords
from corpuslens.functions.stopwords import ENGLISH, without

WORD_SPACE, CHAR_SPACE = "word", "character"
_ENTRY = T.ArrayType(
    T.StructType(
        [
            T.StructField("index", T.IntegerType()),
            T.StructField("tf", T.IntegerType()),
            T.StructField("weight", T.DoubleType()),
        ]
    )
)


def stop_words(o: FeatureOptions) -> tuple[str, ...]:
    w = o.word
    return without(w.preserve, ENGLISH if w.stop_words is None else w.stop_words)


def cutter(space: str, o: FeatureOptions):
    """Function of the parts between spaces of lower-cased ``clean`` texts: what the terms of a space are counted from."""
    if space != CHAR_SPACE:
        words = ModelWords(o.word.strip_accents, frozenset(stop_words(o)))
        return lambda texts: grams.WordCut.of(texts, words)
    low, high = o.char.min_n, o.char.max_n
    if low < 2:
        raise ValueError("character n-grams need at least two characters")
    return lambda texts: grams.CharCut.of(texts, low, high)


def with_terms(df: DataFrame, space: str, output: str, o: FeatureOptions) -> DataFrame:
    """Add the term array of one space, from the ``clean`` column.

    Words become a column of their own first: n-grams read them several times, and nested in one
    expression they would be tokenised again for each use.
    """
    if space == CHAR_SPACE:
        return df.withColumn(output, tk.char_ngrams(F.col("clean"), o.char.min_n, o.char.max_n))
    words = tk.drop_stop_words(tk.model_tokens(F.col("clean"), o.word.strip_accents), stop_words(o))
    return (
        df.withColumn("__words", words)
        .withColumn(output, tk.ngram_range(F.col("__words"), 1, o.word.max_ngram))
        .drop("__words")
    )


def counted_terms(df: DataFrame, space: str, o: FeatureOptions, *by: str) -> DataFrame:
    """``total`` occurrences and ``df`` documents per term (and per ``by``): those of ``with_terms``, one exchange."""
    found = terms_of_runs(df, space, o, *by)
    return found.groupBy(*by, "term").agg(F.sum("total").alias("total"), F.sum("df").alias("df"))


def terms_of_runs(df: DataFrame, space: str, o: FeatureOptions, *by: str) -> DataFrame:
    """What ``counted_terms`` adds up, before any exchange.

    Tasks count runs of rows of a few megabytes, so what is exchanged are distinct terms of runs, not occurrences.
    """
    chars, longest, cut = space == CHAR_SPACE, o.word.max_ngram, cutter(space, o)
    source = df.select(*by, F.lower("clean").alias("__source"))
    limit = grams.RUN_BYTES if chars else 2 * grams.RUN_BYTES

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """The rows of one value of ``by`` each."""
        if not by:
            yield batch
            return
        keys = pa.StructArray.from_arrays([batch.column(k) for k in by], names=list(by)).to_pylist()
        place = {}
        for row, key in enumerate(keys):
            place.setdefault(tuple(key.items()), []).append(row)
        for rows in place.values():
            yield batch.take(pa.array(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in parts(batch)):
            column = part.column("__source")
            for start, rows in grams.runs(grams.sizes_of(column), limit):
                own = cut(grams.Texts.of(column.slice(start, rows)))
                for term, total, documents in [own.totals()] if chars else grams.word_totals(own, longest):
                    same = [part.column(k).take(pa.array(np.full(len(term), start))) for k in by]
                    yield pa.RecordBatch.from_arrays(
                        [*same, term, pa.array(total, pa.int64()), pa.array(documents, pa.int64())],
                        names=[*by, "term", "total", "df"],
                    )

    schema = T.StructType([
        *[df.schema[k] for k in by], T.StructField("term", T.StringType()), T.StructField("total", T.LongType()), T.StructField("df", T.LongType())
    ])
    return source.mapInArrow(run, schema)


def limit_vocabulary(
    totals: DataFrame, documents: int, min_df: int, max_df: float, max_features: int
) -> DataFrame:
    """Document-frequency bounds first, then the most frequent terms (ties by term)."""
    return (
        totals.filter((F.col("df") >= min_df) & (F.col("df") <= max_df * documents))
        .orderBy(F.col("total").desc(), F.col("term"))
        .limit(max_features)
    )


@dataclass(frozen=True)
class Space:
    """Fitted terms of one space in index order, with their statistics."""

    name: str
    terms: tuple[str, ...]
    df: tuple[int, ...]
    idf: np.ndarray
    sublinear: bool


@dataclass(frozen=True)
class FeatureModel:
    """Vocabularies of at most ``max_features`` terms each; small enough to ship to every task."""

    options: FeatureOptions
    documents: int
    spaces: tuple[Space, ...]

    @property
    def size(self) -> int:
        return sum(len(s.terms) for s in self.spaces)

    @property
    def names(self) -> list[tuple[str, str]]:
        return [(s.name, t) for s in self.spaces for t in s.terms]

    @property
    def idf(self) -> np.ndarray:
        return np.concatenate([s.idf for s in self.spaces]) if self.spaces else np.zeros(0)

    def table(self, spark) -> DataFrame:
        """Vocabulary table (space, term, index, df, idf)."""
        table = pa.table(
            {
                "space": [s.name for s in self.spaces for _ in s.terms],
                "term": [t for s in self.spaces for t in s.terms],
                "index": pa.array(np.arange(self.size, dtype=np.int32)),
                "df": pa.array([d for s in self.spaces for d in s.df], pa.int64()),
                "idf": pa.array(self.idf, pa.float64()),
            }
        )
        return spark.createDataFrame(table)


def inverse_df(df: np.ndarray, documents: int) -> np.ndarray:
    """Smoothed inverse document frequency."""
    return np.log((1.0 + documents) / (1.0 + df)) + 1.0


def vocabulary(
    df: DataFrame, space: str, documents: int, o: FeatureOptions = FeatureOptions()
) -> DataFrame:
    """Terms of one space with totals and document counts, limited as configured."""
    totals = counted_terms(df, space, o)
    if space == WORD_SPACE:
        w = o.word
        return limit_vocabulary(totals, documents, w.min_df, w.max_df, w.max_features)
    c = o.char
    return limit_vocabulary(totals, documents, c.min_df, 1.0, c.max_features)


def fit_features(df: DataFrame, o: FeatureOptions = FeatureOptions()) -> FeatureModel:
    """Learn vocabularies and idf from rows with a ``clean`` column."""
    documents = df.count()
    spaces = []
    wanted = [(WORD_SPACE, o.word.sublinear_tf)]
    if o.char.enabled:
        wanted.append((CHAR_SPACE, o.char.sublinear_tf))
    for name, sublinear in wanted:
        found = vocabulary(df, name, documents, o).toArrow()
        counts = found.column("df").to_pylist()
        idf = inverse_df(np.array(counts, dtype=float), documents)
        terms = tuple(found.column("term").to_pylist())
        spaces.append(Space(name, terms, tuple(counts), idf, sublinear))
    return FeatureModel(o, documents, tuple(spaces))


def subset_space(model: FeatureModel, name: str) -> FeatureModel:
    return replace(model, spaces=tuple(s for s in model.spaces if s.name == name))


class Counter:
    """Occurrences of the terms of some spaces in lower-cased ``clean`` texts.

    Each text is cut once, whatever the number of models. Sent to tasks with the function that uses it.
    """

    def __init__(self, spaces: list[tuple[str, tuple[str, ...]]], o: FeatureOptions):
        self.cutters = {name: cutter(name, o) for name, _ in spaces}
        distinct = list(dict.fromkeys(spaces))
        self.places = [distinct.index(space) for space in spaces]
        self.vocabularies = [
            (name, grams.CharVocabulary(pa.array(terms, pa.string())) if name == CHAR_SPACE else grams.WordVocabulary.of(terms))
            for name, terms in distinct
        ]

    def counts(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row lengths, flat indices, flat occurrences) for each space."""
        parts = grams.Texts.of(texts)
        cut = {name: of(parts) for name, of in self.cutters.items()}
        found = [vocabulary.counts(cut[name]) for name, vocabulary in self.vocabularies]
        return [found[place] for place in self.places]

    def by_run(self, use, texts: pa.Array) -> pa.Array:
        """``use`` of the counts and the number of rows of each run of rows: what is held does not grow with the batch."""
        runs = grams.runs(grams.sizes_of(texts), grams.RUN_BYTES) or [(0, 0)]
        parts = [use(self.counts(texts.slice(start, n)), n) for start, n in runs]
        return parts[0] if len(parts) == 1 else pa.concat_arrays(parts)


def counter_of(models: list[FeatureModel]) -> Counter:
    return Counter([(s.name, s.terms) for m in models for s in m.spaces], models[0].options)


def joined(counts, offsets, rows: int, values) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All spaces concatenated by row: (lengths, indices, tf, values)."""
    none = np.zeros(0, np.int64)
    owner = np.concatenate([none, *[sparse.row_ids(lengths) for lengths, _, _ in counts]])
    order = np.argsort(owner, kind="stable")
    return (
        np.bincount(owner, minlength=rows),
        np.concatenate([none, *[index + start for (_, index, _), start in zip(counts, offsets)]])[order],
        np.concatenate([np.zeros(0), *[tf for _, _, tf in counts]])[order],
        np.concatenate([np.zeros(0), *values])[order],
    )


def weigh_counts(counts, settings, rows: int):
    """Weights of all spaces of some rows, concatenated by row: (lengths, indices, tf, weights)."""
    weights, offsets, offset = [], [], 0
    for (lengths, index, tf), (size, idf, sublinear) in zip(counts, settings):
        weight = (1.0 + np.log(tf) if sublinear else tf) * idf[index]
        norm = np.sqrt(sparse.row_sums(lengths, weight * weight))
        norm[norm == 0.0] = 1.0
        weights.append(weight / norm[sparse.row_ids(lengths)])
        offsets.append(offset)
        offset += size
    return joined(counts, offsets, rows, weights)


def settings_of(model: FeatureModel):
    return [(len(s.terms), s.idf, s.sublinear) for s in model.spaces]


def with_features(df: DataFrame, model: FeatureModel, output: str = "features") -> DataFrame:
    """Add the L2-normalised TF-IDF vector of every row; terms outside the vocabulary drop out."""
    settings, size, counter = settings_of(model), model.size, counter_of([model])

    def vectors(counts, rows):
        lengths, indices, _, weights = weigh_counts(counts, settings, rows)
        return sparse.pack(size, lengths, indices, weights)

    @F.arrow_udf(VectorUDT())
    def weigh(texts):
        return counter.by_run(vectors, texts)

    return df.withColumn(output, weigh(F.lower("clean")))


def tfidf_table(df: DataFrame, model: FeatureModel, *keep: str) -> DataFrame:
    """Long table (keep…, space, term, tf, weight). The vocabulary side is capped, so broadcast."""
    settings, counter = settings_of(model), counter_of([model])

    def entries_of(found, rows):
        lengths, indices, counts, weights = weigh_counts(found, settings, rows)
        entries = pa.StructArray.from_arrays(
            [
                pa.array(indices.astype(np.int32)),
                pa.array(counts.astype(np.int32)),
                pa.array(weights),
            ],
            names=["index", "tf", "weight"],
        )
        return sparse.lists(lengths, entries)

    @F.arrow_udf(_ENTRY)
    def weigh(texts):
        return counter.by_run(entries_of, texts)

    entries = df.select(*keep, weigh(F.lower("clean")).alias("entries")).select(
        *keep, F.inline_outer("entries")
    )
    names = model.table(df.sparkSession).select("index", "space", "term")
    return entries.join(F.broadcast(names), "index").select(*keep, "space", "term", "tf", "weight")


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _block_stats(vectors):
    lengths, _, values = sparse.unpack(vectors)
    square = sparse.row_sums(lengths, values * values)
    flat = np.column_stack([lengths.astype(float), np.sqrt(square)]).ravel()
    return sparse.lists(np.full(len(lengths), 2), pa.array(flat))


def vector_stats(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Non-zero count and L2 norm per row."""
    stats = df.select(*keep, _block_stats(column).alias("s"))
    return stats.select(
        *keep, F.col("s")[0].cast("bigint").alias("nnz"), F.col("s")[1].alias("norm")
    )
