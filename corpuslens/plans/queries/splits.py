"""Splits, folds and their audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import split as sp
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query

_ORDERED = f"""{fx.ARTICLES}, ordered AS (
  SELECT row_id, label, count(*) OVER (PARTITION BY label) AS n,
         row_number() OVER (PARTITION BY label ORDER BY {fx.hash60_sql("row_id || '|42'")}, row_id) AS k
  FROM articles)"""


@query("split_group", f"WITH {fx.SPLIT} SELECT row_id, split FROM split")
def split_group(spark, sf_dir):
    return sp.split_groups(fx.prepared(spark, sf_dir)).select("row_id", "split")


@query(
    "split_stratified",
    f"""WITH {_ORDERED}, sized AS (
          SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS train FROM ordered)
        SELECT row_id, label, CASE WHEN k <= train THEN 'train'
          WHEN k <= n - CAST(ceil((n - train) * (0.15::DOUBLE / (0.15::DOUBLE + 0.15::DOUBLE))) AS BIGINT)
          THEN 'validation' ELSE 'test' END AS split FROM sized""",
)
def split_stratified(spark, sf_dir):
    return sp.split_stratified(fx.articles(spark, sf_dir)).select("row_id", "label", "split")


@query(
    "split_time",
    """WITH ordered AS (
         SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS k, count(*) OVER () AS n
         FROM events)
       SELECT event_id AS row_id, CASE WHEN k <= CAST(floor(n * 0.7::DOUBLE) AS BIGINT) THEN 'train'
         WHEN k <= CAST(floor(n * 0.7::DOUBLE) AS BIGINT) + CAST(floor(n * 0.15::DOUBLE) AS BIGINT)
         THEN 'validation' ELSE 'test' END AS split FROM ordered""",
)
def split_time(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"),
    )
    return sp.split_by_time(events).select("row_id", "split")


@query(
    "split_summary",
    f"""WITH {fx.SPLIT} SELECT s.split, count(split.split) AS rows,
        count(*) FILTER (label = 0) AS class_0, count(*) FILTER (label = 1) AS class_1
        FROM (VALUES ('train'), ('validation'), ('test')) s(split)
        LEFT JOIN split ON split.split = s.split GROUP BY s.split""",
)
def split_summary(spark, sf_dir):
    return sp.split_summary(sp.split_groups(fx.prepared(spark, sf_dir))).drop("date_min", "date_max")


_PAIRS = ", ".join(
    f"count(*) FILTER ({a} AND {b}) AS {a}_{b}"
    for a, b in (("train", "validation"), ("train", "test"), ("validation", "test"))
)


@query(
    "split_overlap",
    f"""WITH {fx.PREPARED}, ordered AS (
          SELECT *, row_number() OVER (PARTITION BY label
            ORDER BY {fx.hash60_sql("row_id || '|42'")}, row_id) AS k,
            count(*) OVER (PARTITION BY label) AS n FROM prepared),
        sized AS (SELECT *, CAST(floor(n * 0.7::DOUBLE) AS BIGINT) AS tr FROM ordered),
        placed AS (SELECT document_hash, CASE WHEN k <= tr THEN 'train'
          WHEN k <= n - CAST(ceil((n - tr) * 0.5::DOUBLE) AS BIGINT) THEN 'validation'
          ELSE 'test' END AS split FROM sized),
        seen AS (SELECT document_hash, bool_or(split = 'train') AS train,
          bool_or(split = 'validation') AS validation, bool_or(split = 'test') AS test
          FROM placed GROUP BY 1)
        SELECT {_PAIRS} FROM seen""",
)
def split_overlap(spark, sf_dir):
    """The stratified split ignores copies, so its overlap shows what the audit reports."""
    return sp.split_overlap(sp.split_stratified(fx.prepared(spark, sf_dir)))


@query(
    "split_pivot",
    f"""WITH {fx.SPLIT} SELECT split, count(*) FILTER (label = 0) AS label_0,
        count(*) FILTER (label = 1) AS label_1 FROM split GROUP BY split""",
)
def split_pivot(spark, sf_dir):
    return sp.split_pivot(sp.split_groups(fx.prepared(spark, sf_dir)))


@query(
    "kfold_assign",
    f"""WITH {_ORDERED} SELECT row_id, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY k) - 1
        AS INTEGER) AS fold FROM ordered""",
)
def kfold_assign(spark, sf_dir):
    return sp.assign_folds(fx.articles(spark, sf_dir), 5).select("row_id", "label", "fold")


@query(
    "split_rolling",
    """WITH ordered AS (
         SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS k, count(*) OVER () AS n FROM events),
       placed AS (
         SELECT event_id, (k >= n // 5)::INT + (k >= n * 2 // 5)::INT + (k >= n * 3 // 5)::INT + (k >= n * 4 // 5)::INT AS run FROM ordered)
       SELECT event_id AS row_id, CAST(w AS INTEGER) AS "window", CASE WHEN run = w + 1 THEN 'test' ELSE 'train' END AS split
       FROM placed, range(4) r(w) WHERE run BETWEEN w - 1 AND w + 1""",
)
def split_rolling(spark, sf_dir):
    """Four windows over the events: each trains on two runs of rows and tests on the next."""
    events = fx.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("date"),
    )
    return sp.split_rolling(events, 4, 2).select("row_id", "window", "split")


_SOURCES = f"""WITH RECURSIVE {fx.COLLECTION}, named AS (SELECT row_id, coalesce(subject, '') AS name FROM collection),
total AS (SELECT count(*) AS n FROM named),
large AS (
  SELECT name, rows, row_number() OVER (ORDER BY rows DESC, name) AS k
  FROM (SELECT name, count(*) AS rows FROM named GROUP BY name), total WHERE rows >= 0.001::DOUBLE * n),
greedy(k, name, place, a, b, c) AS (
  SELECT 0::BIGINT, '', 0, 0.7::DOUBLE * n, 0.15::DOUBLE * n, 0.15::DOUBLE * n FROM total
  UNION ALL
  SELECT k, name, place, a - CASE place WHEN 1 THEN rows ELSE 0 END, b - CASE place WHEN 2 THEN rows ELSE 0 END,
         c - CASE place WHEN 3 THEN rows ELSE 0 END
  FROM (SELECT l.k, l.name, l.rows, g.a, g.b, g.c,
               CASE WHEN g.a >= g.b AND g.a >= g.c THEN 1 WHEN g.b >= g.c THEN 2 ELSE 3 END AS place
        FROM greedy g JOIN large l ON l.k = g.k + 1) s),
rest AS (SELECT greatest(a, 0) AS a, greatest(b, 0) AS b, greatest(c, 0) AS c FROM greedy ORDER BY k DESC LIMIT 1),
share AS (SELECT a / coalesce(nullif(a + b + c, 0), 1) AS x, (a + b) / coalesce(nullif(a + b + c, 0), 1) AS y FROM rest)
SELECT row_id, CASE place WHEN 1 THEN 'train' WHEN 2 THEN 'validation' WHEN 3 THEN 'test' ELSE
    CASE WHEN {fx.hash60_sql("n.name || '|42'")} / pow(2.0::DOUBLE, 60) < x THEN 'train'
         WHEN {fx.hash60_sql("n.name || '|42'")} / pow(2.0::DOUBLE, 60) < y THEN 'validation' ELSE 'test' END END AS split
FROM named n CROSS JOIN share LEFT JOIN greedy g ON g.name = n.name AND g.k > 0"""


@query("split_source_heldout", _SOURCES)
def split_source_heldout(spark, sf_dir):
    return sp.split_sources(fx.collection(spark, sf_dir)).select("row_id", "split")
