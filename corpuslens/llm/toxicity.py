"""Toxic spans and document scores from a linear-chain conditional random field.

The field is fitted on the driver from a bounded sample of labelled documents (``fit_rows`` of each class, picked
by a hash of the id). Documents are labelled, words are not: words of toxic samples that carry evidence (see
``crf.lexicon``) count as labelled toxic. Scoring is row-local: forward-backward marginals of every word of
every document. They are summed up by three numbers (the chance that some word is toxic, how many toxic words are
expected, their share), taken over words whose marginal is at least ``FLOOR`` so that thousands of tiny
marginals of a long clean text do not add up; a logistic curve fitted on the same sample makes the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import ALNUM_TABLE, alnum_words, arrow_schema, crc_mod, lean, slices, utf8
from corpuslens.llm.crf import Chain, Layout, fit, marginals

FIT_ROWS = 2000
FLOOR = 0.1
SPAN_FROM = 0.5
THRESHOLD = 0.3
CACHE_WORDS = 300_000

SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text") -> Chain:
    """Fit on about ``fit_rows`` documents of each class, none of the held-out fold.

    A document with several labels counts as toxic if one says so; null labels and ids are left out. Copies of a text
    count once. Without labels of both classes the chain scores everything as clean.
    """
    marked = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").alias("__id"))
        .agg(F.max("toxic").alias("__toxic"))
        .where(crc_mod(F.col("__id"), 4) != 2)
    )
    counts = {r[0]: r[1] for r in marked.groupBy("__toxic").count().collect() if r[0] in (0, 1)}
    share = F.create_map(*[F.lit(x) for c in (0, 1) for x in (c, min(1.0, fit_rows / counts.get(c, 1)))])
    unit = (F.crc32(F.concat(F.lit("fit "), F.col("__id").cast("string")).cast("binary")) / float(1 << 32)).cast("double")
    picked = marked.where(F.col("__toxic").isin(0, 1) & (unit < share[F.col("__toxic")]))
    rows = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text")).where("__text IS NOT NULL").join(F.broadcast(picked), "__id").select("__id", "__toxic", "__text").toArrow()
    # the ids are broadcast: there are about 2 * fit_rows of them at any size of the tables
    # copies of a text, and rows of a repeated id, once; in the order of a hash, so that batches are mixed
    once = {t: (label, i) for i, label, t in sorted(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), utf8(rows.column(2))), reverse=True)}
    order = sorted(once.items(), key=lambda item: (item[1][1] * 2654435761 % (1 << 32), item[1][1]))
    chain = fit([(label, alnum_words(data)) for data, (label, _) in order])
    if {label for _, (label, _) in order} != {0, 1}:
        return chain
    rows, truth = [], np.array([label for _, (label, _) in order])
    for first in range(0, len(order), 200):
        split = [alnum_words(data) for data, _ in order[first : first + 200]]
        known = {w: chain.emission(w) for w in set().union(*split)}
        rows.append(summary(*document_marginals(chain, split, known)))
    # each class weighs what it weighs among the labelled documents, not in the sample
    weight = np.where(truth == 1, counts[1] / truth.sum(), counts[0] / (1 - truth).sum())
    chain.head = logistic(np.concatenate(rows), truth, weight / weight.mean())
    return chain


def document_marginals(chain: Chain, split: list[list[bytes]], known: dict[bytes, float]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(words) for words in split], "int64")
    emissions = np.fromiter((known[w] for words in split for w in words), "float64", int(lengths.sum()))
    return (marginals(chain, emissions, Layout(lengths)) if len(emissions) else emissions), lengths


def summary(prob: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Per text: 1, the log odds that some word is toxic, log of the expected toxic words, log of their share."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    high = prob >= FLOOR
    expected = np.bincount(owner[high], prob[high], len(lengths))
    none = np.exp(np.bincount(owner[high], np.log1p(-np.minimum(prob[high], 1 - 1e-9)), len(lengths)))
    most = np.zeros(len(lengths))
    np.maximum.at(most, owner, prob)
    some = np.clip(np.where(expected > 0, 1 - none, most), 1e-4, 1 - 1e-4)
    share = expected / np.maximum(lengths, 1)
    return np.stack([np.ones(len(lengths)), np.log(some / (1 - some)), np.log1p(expected), np.log1p(1000 * share)], axis=1)


def logistic(x: np.ndarray, truth: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton steps, ridge on all but the intercept."""
    beta, penalty = np.zeros(x.shape[1]), ridge * np.diag([0.0, *[1.0] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        turn = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(beta)), x.T @ (weight * (truth - p)) - penalty @ beta)
        beta += np.clip(turn, -5, 5)
        if np.abs(turn).max() < 1e-8:
            break
    return beta


def score(docs: DataFrame, chain: Chain, text: str = "text", keep: tuple[str, ...] = ("doc_id",), into: str = "toxicity") -> DataFrame:
    """The ``keep`` columns and a struct ``into``: score (0 to 1) and spans (character offsets, score).

    One row per input row; null and empty texts get the score of a text without toxic words. Only the text decides.
    """
    # a text that is kept goes to Python once
    source = text if text in keep else "__text"
    rows = docs.select(*keep) if text in keep else docs.select(*keep, F.col(text).alias(source))
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField(into, RESULT)])
    loaded = docs.sparkSession.sparkContext.broadcast((chain.weights, chain.moves, chain.head))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known, target = Chain(*loaded.value), {}, arrow_schema(schema)
        for batch in slices(batches, source, 2 << 20):
            texts = [data or b"" for data in utf8(batch.column(source))]
            split = [alnum_words(data) for data in texts]
            if len(known) > CACHE_WORDS:
                known = {}
            for word in set().union(*split):
                if word not in known:
                    known[word] = model.emission(word)
            prob, lengths = document_marginals(model, split, known)
            found = scored(prob, lengths, texts, model.head)
            columns = [batch.column(c).cast(target.field(c).type) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, target.field(into).type)], schema=target)

    return rows.mapInArrow(lean(run), schema)


def scored(prob: np.ndarray, lengths: np.ndarray, texts: list[bytes], head: np.ndarray) -> list[dict]:
    value = 1 / (1 + np.exp(-np.clip(summary(prob, lengths) @ head, -30, 30)))
    ends = np.cumsum(lengths)
    high = np.flatnonzero(prob >= SPAN_FROM)
    cuts = np.searchsorted(high, np.concatenate([[0], ends]))
    out = []
    for at, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
        words = high[cuts[at] : cuts[at + 1]]
        out.append({"score": float(value[at]), "spans": spans(texts[at], words - (end - length), prob[words]) if len(words) else []})
    return out


def spans(data: bytes, words: np.ndarray, prob: np.ndarray) -> list[dict]:
    """Runs of neighbouring toxic words as character offsets; a run's score is its largest marginal."""
    places = [m.span() for m in re.finditer(rb"[^ ]+", data.translate(ALNUM_TABLE))]
    out, byte, char, last = [], 0, 0, -2
    for word, p in zip(words.tolist(), prob.tolist()):
        first, end = places[word]
        char += len(data[byte:first].decode("utf-8", "replace"))
        start, char = char, char + len(data[first:end].decode("utf-8", "replace"))
        byte = end
        if word == last + 1:
            out[-1]["end"], out[-1]["score"] = char, max(p, out[-1]["score"])
        else:
            out.append({"start": start, "end": char, "score": p})
        last = word
    return out
