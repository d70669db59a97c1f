"""Event-time roll-ups on a stream: one row per closed window, late rows left out, restarts from a checkpoint.

State is one row per open window and key, whatever the number of events; a hot key is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpuslens.config import SplitOptions
from corpuslens.operators.split import split_groups


def window_totals(
    stream: DataFrame, event_time: str, value: str, keys: tuple[str, ...] = (), window: str = "6 hours", delay: str = "1 day"
) -> DataFrame:
    """``window_start``, keys, rows and total of ``value`` per event-time window.

    A window closes when the watermark (the latest time seen less ``delay``) reaches its end. Rows of closed windows
    are late and left out; rows without a time belong to no window. A null key is a key.
    """
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window).alias("window"), *keys)
        .agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
        .select(F.col("window.start").alias("window_start"), *keys, "rows", "total")
    )


def append_closed(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the windows that what is there closes, and stop; the next start goes on from the checkpoint.

    The Parquet sink lists committed files only, so a batch that was cut short leaves nothing behind.
    """
    return (
        totals.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_splits(articles: DataFrame, path: str, checkpoint: str, o: SplitOptions = SplitOptions()) -> StreamingQuery:
    """Prepared articles of a stream in one folder per split, exactly once.

    The duplicate-safe split hashes a row's own title group, so a row gets the split that the batch job gives it.
    """
    return (
        split_groups(articles, o)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("split")
        .trigger(availableNow=True)
        .start()
    )
