"""Load, validate, prepare, deduplicate."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import contract, dedup
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query
from corpuslens.sources.csv import label_and_union
from corpuslens.sources.tables import (
    read_csv_report,
    read_json_report,
    read_processed,
    shared_root,
    write_csv_report,
    write_json_report,
    write_processed,
)
from corpuslens.operators.split import split_groups

_GAPS = """gaps AS (
  SELECT row_id, CASE WHEN row_id % 11 = 0 THEN NULL ELSE title END AS title,
         CASE WHEN row_id % 13 = 0 THEN NULL ELSE text END AS text, subject,
         CASE WHEN row_id % 17 = 0 THEN NULL WHEN row_id % 19 = 0 THEN 7 ELSE label END AS label
  FROM collection)"""


def _gaps(spark, sf_dir):
    """Documents with missing titles, bodies and labels and some labels outside the domain."""
    id_, label = F.col("row_id"), F.col("label")
    return fx.collection(spark, sf_dir).withColumns(
        {
            "title": F.when(id_ % 11 != 0, F.col("title")),
            "text": F.when(id_ % 13 != 0, F.col("text")),
            "label": F.when(id_ % 17 == 0, None).when(id_ % 19 == 0, 7).otherwise(label),
        }
    )


@query(
    "load_union",
    """SELECT label, CAST(count(*) AS BIGINT) AS rows, CAST(count(subject) AS BIGINT) AS subjects,
              CAST(sum(length(text)) AS BIGINT) AS characters
       FROM (SELECT 0 AS label, text, CAST(NULL AS VARCHAR) AS subject FROM pages_text
             UNION ALL SELECT 1, text, source FROM documents) t GROUP BY label""".replace(
        "pages_text", "(SELECT html AS text FROM pages) p"
    ),
)
def load_union(spark, sf_dir):
    """Two sources with different columns become one labelled table."""
    pages = fx.table(spark, sf_dir, "pages").select(F.col("html").alias("text"))
    documents = fx.table(spark, sf_dir, "documents").select("text", F.col("source").alias("subject"))
    return (
        label_and_union({0: pages, 1: documents})
        .groupBy("label")
        .agg(
            F.count("*").alias("rows"),
            F.count("subject").alias("subjects"),
            F.sum(F.length("text")).alias("characters"),
        )
    )


@query(
    "validate_report",
    f"""WITH {fx.COLLECTION}, {_GAPS} SELECT count(*) AS rows,
        count(*) FILTER (title IS NULL) AS missing_title,
        count(*) FILTER (text IS NULL) AS missing_text,
        count(*) FILTER (label IS NULL) AS missing_label,
        count(*) FILTER (label NOT IN (0, 1)) AS invalid_label,
        count(*) FILTER (label = 0) AS label_0, count(*) FILTER (label = 1) AS label_1
        FROM gaps""",
)
def validate_report(spark, sf_dir):
    return contract.validation_report(_gaps(spark, sf_dir))


@query(
    "combine_text",
    f"""WITH {fx.COLLECTION}, {_GAPS} SELECT row_id, sha256(content) AS content_hash,
        CAST(length(content) AS BIGINT) AS characters
        FROM (SELECT row_id, {fx.content_sql("coalesce(title, '')", "coalesce(text, '')")} AS content
              FROM gaps) t""",
)
def combine_text(spark, sf_dir):
    combined = contract.add_content(contract.validate(_gaps(spark, sf_dir)))
    return combined.select(
        "row_id",
        F.sha2("content", 256).alias("content_hash"),
        F.length("content").cast("bigint").alias("characters"),
    )


@query(
    "word_counts",
    f"""WITH {fx.COLLECTION}, {_GAPS} SELECT row_id, CAST({fx.words_sql('content')} AS BIGINT) AS word_count
        FROM (SELECT row_id, {fx.content_sql("coalesce(title, '')", "coalesce(text, '')")} AS content
              FROM gaps) t WHERE {fx.words_sql('content')} > 1""",
)
def word_counts(spark, sf_dir):
    """Word counts of rows that have words besides the separator."""
    counted = contract.add_content(contract.validate(_gaps(spark, sf_dir)))
    kept = contract.drop_empty(counted, count_separator=False)
    return kept.select("row_id", F.col("word_count").cast("bigint").alias("word_count"))


# Duplicate handling in SQL, one step after the other.
_STEPS = f"""{fx.COLLECTION}, {fx.COPIES}, {fx.prepared_sql('copies')},
first_exact AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title, text, label ORDER BY row_id) AS k
                 FROM prepared) t WHERE k = 1),
clash AS (SELECT document_hash FROM first_exact GROUP BY 1 HAVING count(DISTINCT label) > 1),
consistent AS (
  SELECT * FROM first_exact WHERE document_hash NOT IN (SELECT document_hash FROM clash)),
unique_docs AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY document_hash ORDER BY row_id) AS j
                 FROM consistent) t WHERE j = 1)"""
_STATS = """(SELECT count(*) FROM prepared) - (SELECT count(*) FROM first_exact) AS exact_duplicates_removed,
  (SELECT count(*) FROM consistent) - (SELECT count(*) FROM unique_docs) AS normalized_duplicates_removed,
  (SELECT count(*) FROM first_exact) - (SELECT count(*) FROM consistent) AS contradictory_duplicate_rows_removed"""


def _copies(spark, sf_dir):
    return contract.prepare(fx.with_copies(fx.collection(spark, sf_dir)))


@query("dedup_exact", f"WITH {_STEPS} SELECT row_id FROM first_exact")
def dedup_exact(spark, sf_dir):
    rows = contract.validate(fx.with_copies(fx.collection(spark, sf_dir)))
    return dedup.exact_survivors(rows)


@query("dedup_contradictory", f"WITH {_STEPS} SELECT document_hash FROM clash")
def dedup_contradictory(spark, sf_dir):
    return dedup.contradictory_hashes(dedup.hash_groups(_copies(spark, sf_dir)))


@query(
    "dedup_normalized",
    f"WITH {_STEPS} SELECT row_id, label, word_count, document_hash FROM unique_docs",
)
def dedup_normalized(spark, sf_dir):
    """Whole surviving rows."""
    kept, _ = dedup.remove_duplicates(_copies(spark, sf_dir), "row_id", "label", "word_count", "document_hash")
    return kept.select(
        "row_id", "label", F.col("word_count").cast("bigint").alias("word_count"), "document_hash"
    )


@query("dedup_stats", f"WITH {_STEPS} SELECT {_STATS}")
def dedup_stats(spark, sf_dir):
    return dedup.dedup_stats(dedup.hash_groups(_copies(spark, sf_dir)))


@query(
    "load_summary",
    f"""WITH {_STEPS} SELECT (SELECT count(*) FROM copies) AS raw_rows,
        (SELECT count(*) FILTER (word_count = 0) FROM prepared) AS empty_rows_removed,
        (SELECT count(*) FILTER (word_count < 8) FROM prepared) AS short_rows_retained,
        (SELECT count(*) FROM unique_docs) AS usable_rows,
        (SELECT count(*) FILTER (label = 0) FROM unique_docs) AS class_0,
        (SELECT count(*) FILTER (label = 1) FROM unique_docs) AS class_1, {_STATS}""",
)
def load_summary(spark, sf_dir):
    raw = fx.with_copies(fx.collection(spark, sf_dir))
    kept, stats = dedup.remove_duplicates(contract.prepare(raw))
    return contract.load_summary(raw, kept, stats)


@query(
    "processed_roundtrip",
    f"""WITH {fx.SPLIT} SELECT row_id, label, split, document_hash FROM split WHERE split = 'test'""",
)
def processed_roundtrip(spark, sf_dir):
    """Write the split table, read the test part back (only its folder is scanned)."""
    import uuid

    path = f"{shared_root(spark)}/corpuslens/processed-{uuid.uuid4().hex}"
    write_processed(split_groups(fx.prepared(spark, sf_dir)), path)
    return read_processed(spark, path, "test").select("row_id", "label", "split", "document_hash")


@query(
    "report_roundtrip",
    f"""WITH {fx.COLLECTION}, gaps AS (
          SELECT row_id, label, CASE WHEN row_id % 11 = 0 THEN NULL WHEN row_id % 7 = 0 THEN 'say "no", twice' || chr(10) || row_id ELSE title END AS title FROM collection),
        counts AS (SELECT label, count(*) AS rows, count(title) AS titles FROM gaps GROUP BY 1)
        SELECT 'csv' AS sink, row_id AS key, title AS text FROM gaps
        UNION ALL SELECT 'json', label, rows || '/' || titles FROM counts""",
)
def report_roundtrip(spark, sf_dir):
    """A CSV table with gaps, quotes and line ends, and a JSON report on it, written and read back."""
    import uuid

    root = f"{shared_root(spark)}/corpuslens/reports-{uuid.uuid4().hex}"
    odd = F.concat(F.lit('say "no", twice\n'), F.col("row_id").cast("string"))
    title = F.when(F.col("row_id") % 11 == 0, F.lit(None)).when(F.col("row_id") % 7 == 0, odd).otherwise(F.col("title"))
    rows = fx.collection(spark, sf_dir).select("row_id", "label", title.alias("title"))
    counts = rows.groupBy("label").agg(F.count("*").alias("rows"), F.count("title").alias("titles"))
    write_csv_report(rows.select("row_id", "title"), f"{root}/titles")
    write_json_report(counts, f"{root}/counts")
    csv = read_csv_report(spark, f"{root}/titles", "row_id bigint, title string")
    json = read_json_report(spark, f"{root}/counts", "label int, rows bigint, titles bigint")
    table = csv.select(F.lit("csv").alias("sink"), F.col("row_id").alias("key"), F.col("title").alias("text"))
    report = json.select(F.lit("json"), F.col("label").cast("bigint"), F.concat_ws("/", "rows", "titles"))
    return table.union(report)


_CELLS = ("doc_id", "lang", "n_chars", "source", "text")
_ROW = " || chr(31) || ".join(f"coalesce(CAST({c} AS VARCHAR), chr(0))" for c in _CELLS)


@query(
    "table_fingerprint",
    f"""SELECT count(*) AS rows, CAST(sum(h) AS VARCHAR) AS hash_sum, bit_xor(h) AS hash_xor
        FROM (SELECT {fx.hash60_sql(_ROW)} AS h FROM documents) t""",
)
def table_fingerprint(spark, sf_dir):
    return contract.table_fingerprint(fx.table(spark, sf_dir, "documents"))
