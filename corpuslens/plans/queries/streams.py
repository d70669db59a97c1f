"""Streams over the given tables; each runs to the end of what is there."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from corpuslens.operators.contract import prepare
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query
from corpuslens.sources.tables import read_processed, shared_root
from corpuslens.streaming import rollup

BATCHES = 4

_WINDOWS = f"""WITH arrived AS (
  SELECT ts, event_type, value, least({BATCHES - 1}, (event_id + CASE WHEN event_id % 37 = 0 THEN n // 5 ELSE 0 END) * {BATCHES} // n) AS batch
  FROM events, (SELECT max(event_id) + 1 AS n FROM events)),
seen AS (SELECT batch, max(ts) AS latest FROM arrived GROUP BY batch),
mark AS (SELECT batch, (SELECT max(latest) FROM seen s WHERE s.batch < b.batch) - INTERVAL 1 DAY AS closed FROM seen b),
kept AS (SELECT a.*, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS start, closed FROM arrived a JOIN mark USING (batch))
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS rows, round(sum(value), 4) AS total
FROM kept, (SELECT max(ts) - INTERVAL 1 DAY AS final FROM events)
WHERE (closed IS NULL OR start + INTERVAL 6 HOUR > closed) AND start + INTERVAL 6 HOUR <= final
GROUP BY start, event_type"""


@query("stream_rollup", _WINDOWS)
def stream_rollup(spark, sf_dir):
    """Events arriving in four loads, some of them days late; the stream stops after each load and starts again."""
    # the table's times have no zone; they are read and shown as UTC whatever the session's zone is
    moment = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()).alias("ts")
    events = fx.table(spark, sf_dir, "events").select("event_id", moment, "event_type", "value")
    count = events.agg((F.max("event_id") + 1).alias("n")).first()["n"]
    if count is None:
        count = 1
    arrival = F.col("event_id") + F.when(F.col("event_id") % 37 == 0, count // 5).otherwise(0)
    load = F.least(F.lit(BATCHES - 1), F.floor(arrival * BATCHES / count))
    base = f"{shared_root(spark)}/corpuslens/rollup-{uuid.uuid4().hex}"
    rows = events.drop("event_id")
    for number in range(BATCHES):
        events.where(load == number).drop("event_id").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        totals = rollup.window_totals(stream, "ts", "value", ("event_type",))
        rollup.append_closed(totals, f"{base}/out", f"{base}/state").awaitTermination()
    start = F.date_format(F.to_utc_timestamp("window_start", F.current_timezone()), "yyyy-MM-dd HH:mm:ss").alias("window_start")
    return spark.read.parquet(f"{base}/out").select(start, "event_type", "rows", F.round("total", 4).alias("total"))


@query("split_group_stream", f"WITH {fx.SPLIT} SELECT row_id, split FROM split")
def split_group_stream(spark, sf_dir):
    """Articles arriving as a stream, prepared, split and stored by split."""
    documents = fx.table_stream(spark, sf_dir, "documents").select("doc_id", "text", "source")
    base = f"{shared_root(spark)}/corpuslens/split-{uuid.uuid4().hex}"
    arrived = prepare(fx.labelled(documents, fx.table(spark, sf_dir, "labels")))
    rollup.append_splits(arrived, f"{base}/out", f"{base}/state").awaitTermination()
    return read_processed(spark, f"{base}/out").select("row_id", "split")
