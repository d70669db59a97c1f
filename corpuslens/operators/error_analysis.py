"""Misclassified rows with explanations and a review hint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.score import PROBABILITY, TextModel, predicted_label, with_scores

# Limits and wording of the review hints, in the order they are tried.
SHORT_WORDS, HIGH_CONFIDENCE, HEADLINE_LENGTH = 20, 0.85, 500
REASON_SHORT = "Very short input provides limited evidence."
REASON_CONFIDENT = (
    "High-confidence error; review source artifacts, duplication, and temporal drift."
)
REASON_QUOTED = "Quoted or mixed-voice language may resemble the opposite class."
REASON_DEFAULT = (
    "Vocabulary, topic, satire/opinion, or source style may differ from training patterns."
)


def possible_reason(words: Column, confidence: Column, content: Column) -> Column:
    return (
        F.when(words < SHORT_WORDS, REASON_SHORT)
        .when(confidence >= HIGH_CONFIDENCE, REASON_CONFIDENT)
        .when(F.contains(content, F.lit('"')), REASON_QUOTED)
        .otherwise(REASON_DEFAULT)
    )


def confidence_of(prediction: Column, score: Column, kind: str) -> Column:
    if kind != PROBABILITY:
        return F.lit(None).cast("double")
    return F.when(prediction == 1, score).otherwise(1 - score)


def error_table(df: DataFrame, model: TextModel, top_n: int = 5) -> DataFrame:
    """False positives and negatives of rows with title, content, clean, word_count and label.

    Scores and terms come from one pass: counting the terms of a row costs more than explaining it.
    """
    kind = model.score_kind
    predicted = predicted_label(F.col("scored.score"), kind)
    scored = with_scores(df, model, top_n).withColumn("predicted_label", predicted)
    wrong = scored.filter(F.col("predicted_label") != F.col("label"))
    confidence = confidence_of(F.col("predicted_label"), F.col("scored.score"), kind)

    def joined(side: str) -> Column:
        return F.array_join(F.transform(f"scored.{side}", lambda t: t["feature"]), ", ")

    return wrong.select(
        F.col("row_id").alias("row_index"),
        F.substring("title", 1, HEADLINE_LENGTH).alias("headline"),
        F.col("label").alias("true_label"),
        "predicted_label",
        confidence.alias("confidence"),
        F.lit(kind).alias("score_kind"),
        joined("toward_fake").alias("toward_fake_features"),
        joined("toward_real").alias("toward_real_features"),
        "word_count",
        possible_reason(F.col("word_count"), confidence, F.col("content")).alias(
            "possible_reason"
        ),
    )
