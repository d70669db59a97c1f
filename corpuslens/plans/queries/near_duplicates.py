"""Near-duplicate classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators.near_duplicates import LOWER, PERCENT, UPPER, WORDS, near_duplicates
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query

_CLASSES = rf"""
WITH RECURSIVE {fx.COLLECTION}, worded AS (
  SELECT row_id, regexp_extract_all(translate(coalesce(title, '') || ' ' || coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\x20\x09-\x0D]+') AS w FROM collection),
runs AS (
  SELECT row_id, unnest(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - {WORDS - 1}, 1) + 1 END),
                                       lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS shingle FROM worded),
sets AS (SELECT DISTINCT row_id, shingle FROM runs),
sizes AS (SELECT row_id, count(*) AS n FROM sets GROUP BY row_id),
shared AS (
  SELECT x.row_id AS a, y.row_id AS b, count(*) AS common
  FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.row_id < y.row_id GROUP BY x.row_id, y.row_id),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.row_id = a JOIN sizes t ON t.row_id = b
  WHERE 100 * common >= {PERCENT} * (s.n + t.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(row_id, other) AS (
  SELECT row_id, row_id FROM collection
  UNION SELECT r.row_id, w.b FROM reach r JOIN ways w ON r.other = w.a),
classes AS (SELECT row_id, min(other) AS class_id FROM reach GROUP BY row_id)
SELECT row_id, coalesce(n, 0) AS n_shingles, class_id, row_id = class_id AS kept
FROM classes LEFT JOIN sizes USING (row_id)
"""


@query("near_dup_classes", _CLASSES)
def near_dup_classes(spark, sf_dir):
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("text", F.lit("")))
    return near_duplicates(fx.collection(spark, sf_dir), text)
