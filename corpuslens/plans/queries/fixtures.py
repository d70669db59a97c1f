"""Input views over the given tables, in Spark and in SQL.

``articles`` are labelled documents with the first line as title. ``collection`` is every document,
labelled by parity of its id, so that copies with opposite labels exist. ``marked`` puts agency
datelines, addresses, contractions and the like in front of titles, by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions import unicode as uni
from corpuslens.functions.text import CONTRACTIONS
from corpuslens.operators.contract import prepare

MARKERS = (
    "LONDON (Reuters) - ",
    "See https://Example.com/a?b=1 or www.example.org and write Editor.one@Example.com now ",
    "It’s clear they can't, won't, didn’t; we've said he'd go, I'm sure they cannot. ",
    "Copyright 2017 the Associated Press: Sooooo gooood on Jan 5, 2017 at 1,234.5 ",
    "",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of one table as a stream, be the table one file or a folder of files.

    A file stream takes a folder or a glob; a filter on file names would miss the files inside a folder.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over as many tasks as there are cores, where the files give fewer.

    A table in one row group would otherwise be normalised, tokenised and counted by one task. Tables of many
    files stay as they are: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def _titled(df: DataFrame) -> DataFrame:
    title = F.substring_index("text", "\n", 1)
    return df.withColumns({"title": title, "body": F.substring("text", F.length(title) + 2, F.length("text"))})


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    return labelled(documents, table(spark, sf_dir, "labels"))


def labelled(documents: DataFrame, labels: DataFrame) -> DataFrame:
    joined = _titled(documents.join(labels.select("doc_id", "quality"), "doc_id"))
    return joined.select(
        F.col("doc_id").alias("row_id"),
        "title",
        F.col("body").alias("text"),
        F.col("source").alias("subject"),
        F.col("quality").alias("label"),
    )


def collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _titled(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id"))
    return documents.select(
        F.col("doc_id").alias("row_id"),
        "title",
        F.col("body").alias("text"),
        F.col("source").alias("subject"),
        (F.col("doc_id") % 2).cast("int").alias("label"),
    )


def with_copies(df: DataFrame) -> DataFrame:
    """Every tenth row again with markup around its body: equal only after normalising."""
    copies = df.filter(F.col("row_id") % 10 == 0).withColumns(
        {
            "row_id": F.col("row_id") * 2 + 1,
            "text": F.concat(F.lit("<b>"), F.col("text"), F.lit("</b>")),
        }
    )
    return df.withColumn("row_id", F.col("row_id") * 2).unionByName(copies)


def marked(df: DataFrame) -> DataFrame:
    chosen = F.lit("")
    for k, marker in enumerate(MARKERS):
        chosen = F.when(F.col("row_id") % len(MARKERS) == k, marker).otherwise(chosen)
    return df.withColumn("title", F.concat(chosen, "title"))


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(articles(spark, sf_dir))


# ---- the same views in SQL -------------------------------------------------------------------


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SPACES = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = uni.WORD
SPACE_LIST = "(" + " || ".join(f"chr({ord(c)})" for c in uni.SPACE_CHARS) + ")"

ARTICLES = """articles AS (
  SELECT d.doc_id AS row_id, split_part(d.text, chr(10), 1) AS title,
         substr(d.text, length(split_part(d.text, chr(10), 1)) + 2) AS text,
         d.source AS subject, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

COLLECTION = """collection AS (
  SELECT doc_id AS row_id, split_part(text, chr(10), 1) AS title,
         substr(text, length(split_part(text, chr(10), 1)) + 2) AS text,
         source AS subject, CAST(doc_id % 2 AS INTEGER) AS label
  FROM documents)"""

COPIES = """copies AS (
  SELECT row_id * 2 AS row_id, title, text, subject, label FROM collection
  UNION ALL
  SELECT row_id * 2 + 1, title, '<b>' || text || '</b>', subject, label
  FROM collection WHERE row_id % 10 = 0)"""


def marked_sql(source: str, name: str = "marked") -> str:
    cases = " ".join(f"WHEN {k} THEN {quote(m)}" for k, m in enumerate(MARKERS))
    return f"""{name} AS (
  SELECT row_id, CASE row_id % {len(MARKERS)} {cases} END || title AS title, text, subject, label
  FROM {source})"""


def sub(expr: str, pattern: str, replacement: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {quote(pattern)}, {quote(replacement)}, '{flags}')"


def strip_sql(expr: str) -> str:
    return f"trim({expr}, {SPACE_LIST})"


def apostrophes_sql(expr: str) -> str:
    return f"translate({expr}, chr(8217) || chr(8216), '''''')"


def tags_sql(expr: str) -> str:
    return sub(expr, "<[^>]+>", " ")


def email_sql(expr: str) -> str:
    return sub(expr, rf"[{WORD}][{WORD}.+-]*@[{WORD}.-]+\.[a-z]{{2,}}\b", " emailtoken ", "gi")


def url_sql(expr: str, token: str = " urltoken ") -> str:
    return sub(expr, rf"(?:https?://|www\.)[^{SPACES}]+", token, "gi")


def prefix_sql(expr: str) -> str:
    pattern = (
        rf"^[{SPACES}]*(?:[A-Z][A-Z .'-]{{1,35}})?[{SPACES}]*\((?:Reuters|AP)\)[{SPACES}]*"
        rf"[-–—:][{SPACES}]*"
    )
    return sub(expr, pattern, " ", "gi")


def marker_sql(expr: str) -> str:
    pattern = rf"\b(?:reuters|associated[{SPACES}]+press|copyright[{SPACES}]+[0-9]{{4}})\b"
    return sub(expr, pattern, " ", "gi")


def contractions_sql(expr: str) -> str:
    for short, full in CONTRACTIONS.items():
        expr = f"replace({expr}, {quote(short)}, {quote(full)})"
    return expr


def repeats_sql(expr: str) -> str:
    for code in range(ord("a"), ord("z") + 1):
        letter = chr(code)
        expr = sub(expr, f"{letter}{{4,}}", letter * 3)
    return expr


def numbers_sql(expr: str) -> str:
    return sub(expr, r"\b[0-9]+(?:[.,][0-9]+)*\b", " numbertoken ")


def keep_sql(expr: str) -> str:
    expr = sub(expr, rf"[^{WORD}{SPACES}!?'\-<>]", " ")
    return f"trim({sub(f'replace({expr}, {quote(chr(95))}, {quote(chr(32))})', f'[{SPACES}]+', ' ')})"


def normalize_sql(expr: str) -> str:
    """The default normaliser for texts that NFKC and entity decoding leave alone."""
    expr = apostrophes_sql(f"coalesce({expr}, '')")
    expr = url_sql(email_sql(tags_sql(expr)))
    expr = f"lower({marker_sql(prefix_sql(expr))})"
    return keep_sql(repeats_sql(contractions_sql(expr)))


def content_sql(title: str = "title", text: str = "text") -> str:
    return strip_sql(f"{strip_sql(title)} || ' bodytext ' || {strip_sql(text)}")


def words_sql(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '[^{SPACES}]+'))"


def prepared_sql(source: str = "articles", name: str = "prepared") -> str:
    """CTEs ending in ``name``: the source with content, word_count, clean and document_hash."""
    return f"""{name}_content AS (
  SELECT *, {content_sql()} AS content FROM {source}),
{name}_clean AS MATERIALIZED (
  SELECT *, CAST({words_sql('content')} AS BIGINT) AS word_count,
         {normalize_sql('content')} AS clean FROM {name}_content),
{name} AS (SELECT *, sha256(clean) AS document_hash FROM {name}_clean)"""


def hash60_sql(expr: str) -> str:
    return f"CAST('0x' || substr(sha256({expr}), 1, 15) AS BIGINT)"


def group_sql(title: str = "title") -> str:
    """Title group of a row with ``document_hash``."""
    words = f"string_split({normalize_sql(title)}, ' ')"
    key = f"array_to_string(({words})[1:30], ' ')"
    return f"sha256(coalesce(nullif({key}, ''), document_hash))"


PREPARED = f"{ARTICLES},\n{prepared_sql()}"
SPLIT = f"""{PREPARED},
grouped AS MATERIALIZED (SELECT *, {group_sql()} AS title_group FROM prepared),
split AS (
  SELECT *, CASE WHEN pos < 0.7::DOUBLE THEN 'train'
                 WHEN pos < 0.7::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, {hash60_sql("title_group || '|42'")} / pow(2.0::DOUBLE, 60) AS pos FROM grouped))"""
