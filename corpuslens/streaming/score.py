"""Scoring of document streams.

Scoring is row-local, so the batch operator runs unchanged on a stream. Only the roll-up keeps
state: one row per event-time window and band, dropped by the watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslens.config import ScoringOptions
from corpuslens.operators.score import TextModel, predict


def score_stream(
    stream: DataFrame, model: TextModel, text: str = "text", o: ScoringOptions = ScoringOptions()
) -> DataFrame:
    """Prediction records of a streaming DataFrame."""
    return predict(stream, model, text, o)


def band_counts(
    scored: DataFrame, event_time: str, window: str = "1 hour", delay: str = "10 minutes"
) -> DataFrame:
    """Rows, rejections and warned rows per event-time window and confidence band."""
    return (
        scored.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window).alias("window"), "confidence_band")
        .agg(
            F.count("*").alias("rows"),
            F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"),
            F.count_if(F.size("warnings") > 0).alias("warned"),
        )
        .select(F.col("window.start").alias("window_start"), "confidence_band", "rows", "rejected", "warned")
    )


def write_stream(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append every available record to a Parquet folder, exactly once."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
