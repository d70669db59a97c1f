"""Input checks and table scoring.

One vectorised Arrow function turns the count vectors of a row into score, coverage and term
contributions, for a single model or a calibrated ensemble. Rows never leave their partition, so
the same plan runs on a streaming DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.config import ScoringOptions, TextOptions
from corpuslens.functions import sparse
from corpuslens.functions import text as tx
from corpuslens.functions import tokens as tk
from corpuslens.operators.features import (
    WORD_SPACE,
    FeatureModel,
    counter_of,
    settings_of,
    weigh_counts,
)
from corpuslens.operators.models import PROBABILITY, LinearModel

# Messages and bands of the prediction record.
BLANK = "Enter a headline or article before analyzing."
TOO_LONG = "Input exceeds the {:,}-character safety limit."
NO_WORDS = "The input does not contain analyzable words."
SHORT = "Only {} words were provided; short inputs are less reliable."
FOREIGN = "The text may be non-English or mixed-language; this model was trained on English news."
REPETITIVE = "The input is highly repetitive and unlike a normal news article."
UNFAMILIAR = (
    "Very few learned vocabulary features matched this input; it may be out of distribution."
)
HIGH_BAND, MODERATE_BAND = 0.85, 0.65
METHOD = "local_tfidf_times_linear_coefficient"
EXPLANATION_DISCLAIMER = (
    "Highlighted terms are statistical signals learned from the training dataset. "
    "They do not independently prove that the article is true or false."
)
PREDICTION_DISCLAIMER = (
    "This model identifies statistical language patterns. It does not verify facts, "
    "consult sources, or determine objective truth."
)


@dataclass(frozen=True)
class Calibrator:
    """``sigmoid``: slope in ``x``, offset in ``y``. ``isotonic``: interpolation knots."""

    kind: str
    x: np.ndarray
    y: np.ndarray

    def apply(self, values: np.ndarray) -> np.ndarray:
        if self.kind == "sigmoid":
            return 1.0 / (1.0 + np.exp(-(self.x[0] * values + self.y[0])))
        return np.interp(values, self.x, self.y)


@dataclass(frozen=True)
class Member:
    features: FeatureModel
    linear: LinearModel
    calibrator: Calibrator | None = None


@dataclass(frozen=True)
class TextModel:
    """One fitted pipeline, or the members of a calibrated ensemble."""

    members: tuple[Member, ...]
    text: TextOptions = field(default_factory=TextOptions)
    version: str = "unknown"

    @property
    def calibrated(self) -> bool:
        return any(m.calibrator is not None for m in self.members)

    @property
    def score_kind(self) -> str:
        return PROBABILITY if self.calibrated else self.members[0].linear.score_kind


_TERMS = T.ArrayType(
    T.StructType(
        [T.StructField("feature", T.StringType()), T.StructField("contribution", T.DoubleType())]
    )
)
_SCORED = T.StructType(
    [
        T.StructField("score", T.DoubleType()),
        T.StructField("coverage", T.DoubleType()),
        T.StructField("toward_fake", _TERMS),
        T.StructField("toward_real", _TERMS),
    ]
)


def raw_score(linear: LinearModel, margin: np.ndarray) -> np.ndarray:
    if linear.link == "constant":
        return np.full(len(margin), 1.0 if linear.intercept > 0 else 0.0)
    if linear.link == "sigmoid":
        return 1.0 / (1.0 + np.exp(-margin))
    return margin


def _member_score(member: Member, margin: np.ndarray) -> np.ndarray:
    if member.calibrator is None:
        return raw_score(member.linear, margin)
    # Calibrators are fitted on decision values where the classifier has them.
    values = margin if member.linear.explainable else raw_score(member.linear, margin)
    return member.calibrator.apply(values)


def _word_ids(members: tuple[Member, ...]):
    """Shared word dictionary: terms in sorted order, and per member feature index -> id or -1."""
    terms = sorted(
        {
            t
            for m in members
            if m.linear.explainable
            for space, t in m.features.names
            if space == WORD_SPACE and len(t.strip()) > 1
        }
    )
    position = {t: i for i, t in enumerate(terms)}
    ids = []
    for m in members:
        known = m.linear.explainable
        ids.append(
            np.array(
                [
                    position.get(t, -1) if known and space == WORD_SPACE else -1
                    for space, t in m.features.names
                ],
                dtype=np.int64,
            )
        )
    return np.array(terms, dtype=object), ids


def _scorer(model: TextModel, top_n: int):
    """Function of counts and number of rows: struct(score, coverage, toward_fake, toward_real)."""
    fitted = [m.features for m in model.members]
    settings = [settings_of(f) for f in fitted]
    terms, ids = _word_ids(model.members) if top_n else (np.array([], dtype=object), [])
    # Only arrays travel with the function; feature names are already folded into ``terms``.
    light = [
        (
            m.linear.coefficients,
            m.linear.intercept,
            max(m.features.size, 1),
            Member(None, replace(m.linear, coefficients=None), m.calibrator),
        )
        for m in model.members
    ]
    widths = [len(f.spaces) for f in fitted]

    def scored(counts, count):
        total_score, total_coverage = np.zeros(count), np.zeros(count)
        owners, keys, parts = [], [], []
        start = 0
        for number, (w, b, size, member) in enumerate(light):
            own = counts[start : start + widths[number]]
            start += widths[number]
            lengths, index, _, weight = weigh_counts(own, settings[number], count)
            contribution = weight * w[index]
            margin = sparse.row_sums(lengths, contribution) + b
            total_score += _member_score(member, margin)
            total_coverage += lengths / size
            if len(terms):
                word = ids[number][index]
                kept = word >= 0
                owners.append(sparse.row_ids(lengths)[kept])
                keys.append(word[kept])
                parts.append(contribution[kept])
        if owners:
            flat = np.concatenate(owners) * len(terms) + np.concatenate(keys)
            unique, place = np.unique(flat, return_inverse=True)
            mean = np.bincount(place, np.concatenate(parts), len(unique)) / np.bincount(
                place, minlength=len(unique)
            )
            owner, key = np.divmod(unique, len(terms))
        else:
            mean, owner, key = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        lengths = np.bincount(owner, minlength=count)

        def strongest(sign):
            strength = sign * mean
            chosen, sizes = sparse.top_entries(lengths, strength, key, strength > 0, top_n)
            flat_terms = pa.StructArray.from_arrays(
                [pa.array(terms[key[chosen]], pa.string()), pa.array(strength[chosen])],
                names=["feature", "contribution"],
            )
            return sparse.lists(sizes, flat_terms)

        return pa.StructArray.from_arrays(
            [
                pa.array(total_score / len(light)),
                pa.array(total_coverage / len(light)),
                strongest(-1.0),
                strongest(1.0),
            ],
            names=["score", "coverage", "toward_fake", "toward_real"],
        )

    return scored


def with_scores(df: DataFrame, model: TextModel, top_n: int = 0, output: str = "scored") -> DataFrame:
    """Add struct(score, coverage, toward_fake, toward_real) from the ``clean`` column."""
    return with_all_scores(df, {output: model}, top_n)


def with_all_scores(df: DataFrame, models: dict[str, TextModel], top_n: int = 0) -> DataFrame:
    """``with_scores`` of several models (output -> model); terms are counted once, also of equal vocabularies."""
    counter = counter_of([m.features for model in models.values() for m in model.members])
    scorers = [_scorer(model, top_n) for model in models.values()]
    widths = [sum(len(m.features.spaces) for m in model.members) for model in models.values()]
    names = list(models)

    def scored(counts, count):
        start, found = 0, []
        for scorer, width in zip(scorers, widths):
            found.append(scorer(counts[start : start + width], count))
            start += width
        return pa.StructArray.from_arrays(found, names=names)

    @F.arrow_udf(T.StructType([T.StructField(name, _SCORED) for name in names]))
    def apply(texts):
        return counter.by_run(scored, texts)

    whole = df.withColumn("__scores", apply(F.lower("clean")))
    return whole.withColumns({name: F.col(f"__scores.{name}") for name in names}).drop("__scores")


def predicted_label(score: Column, kind: str) -> Column:
    return (score > (0.5 if kind == PROBABILITY else 0.0)).cast("int")


def scored_labels(df: DataFrame, model: TextModel, *keep: str) -> DataFrame:
    """(keep…, label, prediction, score) for evaluation."""
    kind = model.score_kind
    scored = with_scores(df, model)
    return scored.select(
        *keep,
        "label",
        predicted_label(F.col("scored.score"), kind).alias("prediction"),
        F.col("scored.score").alias("score"),
    )


def assess(df: DataFrame, text: str = "text", o: ScoringOptions = ScoringOptions()) -> DataFrame:
    """Add stripped ``input``, counts, ``reject_reason`` (null when accepted) and ``warnings``."""
    value = F.col("input")
    words = F.col("__words")
    count = F.size(words)
    letters = F.length(F.regexp_replace(value, r"[^\p{L}]+", ""))
    ascii_letters = F.length(F.regexp_replace(value, r"[^A-Za-z]+", ""))
    distinct = F.size(F.array_distinct(F.transform(words, F.lower)))
    rejected = (
        F.when(value == "", BLANK)
        .when(F.length(value) > o.maximum_characters, TOO_LONG.format(o.maximum_characters))
        .when(count == 0, NO_WORDS)
    )
    before, after = SHORT.split("{}")
    warnings = F.array_compact(
        F.array(
            F.when(
                count < o.minimum_words,
                F.concat(F.lit(before), count.cast("string"), F.lit(after)),
            ),
            F.when((letters > 0) & (ascii_letters / letters < o.ascii_ratio), FOREIGN),
            F.when((distinct <= 2) & (count >= 5), REPETITIVE),
        )
    )
    return (
        df.withColumn("input", tx.strip(F.coalesce(F.col(text).cast("string"), F.lit(""))))
        .withColumn("__words", tk.gate_tokens(F.col("input")))
        .withColumns(
            {
                "word_count": count,
                "character_count": F.length(value),
                "reject_reason": rejected,
            }
        )
        .withColumn(
            "warnings",
            F.when(F.col("reject_reason").isNull(), warnings),
        )
        .drop("__words")
    )


def confidence_band(confidence: Column) -> Column:
    return (
        F.when(confidence.isNull(), "Unavailable")
        .when(confidence >= HIGH_BAND, "High")
        .when(confidence >= MODERATE_BAND, "Moderate")
        .otherwise("Low")
    )


def predict(
    df: DataFrame, model: TextModel, text: str = "text", o: ScoringOptions = ScoringOptions()
) -> DataFrame:
    """Full prediction record per row. Rejected rows keep a reason and null results."""
    accepted = F.col("reject_reason").isNull()
    checked = assess(df, text, o).withColumn("__text", F.when(accepted, F.col("input")))
    cleaned = tx.with_normalized(checked, {"__text": "clean"}, model.text)
    scored = with_scores(cleaned, model, o.top_features)
    kind = model.score_kind
    score = F.col("scored.score")
    label = predicted_label(score, kind)
    probability = F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))
    if kind != PROBABILITY:
        probability = F.lit(None).cast("double")
    confidence = F.when(label == 1, probability).otherwise(1 - probability)
    coverage = F.col("scored.coverage")
    warnings = F.when(
        coverage < o.minimum_coverage, F.array_append("warnings", F.lit(UNFAMILIAR))
    ).otherwise(F.col("warnings"))

    def shown(value: Column) -> Column:
        return F.when(accepted, value)

    explanation = F.struct(
        F.col("scored.toward_fake").alias("toward_fake"),
        F.col("scored.toward_real").alias("toward_real"),
        coverage.alias("vocabulary_coverage"),
        F.lit(METHOD).alias("method"),
        F.lit(EXPLANATION_DISCLAIMER).alias("disclaimer"),
    )
    return scored.select(
        *df.columns,
        "reject_reason",
        shown(label).alias("label_predicted"),
        shown(F.when(label == 1, o.class_names[1]).otherwise(o.class_names[0])).alias("class_name"),
        shown(confidence).alias("estimated_model_probability"),
        shown(probability).alias("probability_real"),
        shown(confidence_band(confidence)).alias("confidence_band"),
        shown(F.lit(kind)).alias("score_kind"),
        F.col("word_count").alias("input_words"),
        F.col("character_count").alias("input_characters"),
        shown(warnings).alias("warnings"),
        shown(explanation).alias("explanation"),
        F.lit(model.version).alias("model_version"),
        F.lit(PREDICTION_DISCLAIMER).alias("disclaimer"),
    )
