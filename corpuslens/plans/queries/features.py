"""Tokens, vocabulary and TF-IDF."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.config import NEGATIONS, FeatureOptions
from corpuslens.functions import tokens as tk
from corpuslens.functions.stopwords import without
from corpuslens.operators import drift
from corpuslens.operators import features as ft
from corpuslens.operators.split import split_groups
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.leakage import grams_sql
from corpuslens.plans.queries.registry import query, r6
from corpuslens.sources.tables import materialize

_STOP = without(NEGATIONS)
_STOP_SQL = "(" + ", ".join(fx.quote(w) for w in _STOP) + ")"


def tokens_sql(expr: str = "clean") -> str:
    """Model words of a clean text: other letters and digits become '_' so that edges are ASCII."""
    plain = fx.sub(f"strip_accents(lower({expr}))", r"[^\x{0}-\x{7f}]", "_")
    pattern = fx.quote(r"\b[a-zA-Z][a-zA-Z'-]+\b")
    return f"regexp_extract_all({plain}, {pattern})"


def kept_sql(expr: str = "clean") -> str:
    return f"list_filter({tokens_sql(expr)}, lambda t: t NOT IN {_STOP_SQL})"


def word_terms_sql(source: str, keep: str) -> str:
    return f"""SELECT {keep}, unnest(list_concat(t, {grams_sql('t', 2)})) AS term
FROM (SELECT {keep}, {kept_sql()} AS t FROM {source}) w"""


def char_terms_sql(source: str, keep: str) -> str:
    return f"""SELECT {keep}, unnest(list_transform(range(1, length(w) - n + 2),
       lambda i: substr(w, i, n))) AS term
FROM (SELECT {keep}, ' ' || unnest(string_split(clean, ' ')) || ' ' AS w FROM {source}
      WHERE clean <> '') p, (VALUES (3), (4), (5)) s(n) WHERE length(w) >= n"""


def vocabulary_ctes(source: str, name: str = "vocab") -> str:
    """Vocabulary (space, term, df, total, idf) of ``source`` rows with row_id and clean."""
    return f"""{name}_n AS (SELECT count(*) AS n FROM {source}),
{name}_word AS (
  SELECT term, count(*) AS total, count(DISTINCT row_id) AS df
  FROM ({word_terms_sql(source, 'row_id')}) t GROUP BY 1
  HAVING count(DISTINCT row_id) >= 2
     AND count(DISTINCT row_id) <= 0.98::DOUBLE * (SELECT n FROM {name}_n)
  ORDER BY total DESC, term LIMIT 50000),
{name}_char AS (
  SELECT term, count(*) AS total, count(DISTINCT row_id) AS df
  FROM ({char_terms_sql(source, 'row_id')}) t GROUP BY 1
  HAVING count(DISTINCT row_id) >= 3 ORDER BY total DESC, term LIMIT 30000),
{name} AS MATERIALIZED (
  SELECT space, term, total, df, ln((1 + n)::DOUBLE / (1 + df)) + 1 AS idf FROM (
    SELECT 'word' AS space, * FROM {name}_word
    UNION ALL SELECT 'character', * FROM {name}_char) v, {name}_n)"""


def tfidf_ctes(source: str, vocab: str = "vocab", name: str = "tfidf", key: str = "row_id") -> str:
    return f"""{name}_tf AS (
  SELECT 'word' AS space, {key}, term, count(*) AS tf FROM ({word_terms_sql(source, key)}) t GROUP BY ALL
  UNION ALL
  SELECT 'character', {key}, term, count(*) FROM ({char_terms_sql(source, key)}) t GROUP BY ALL),
{name}_raw AS (
  SELECT f.space, {key}, f.term, tf, (1 + ln(tf::DOUBLE)) * idf AS w
  FROM {name}_tf f JOIN {vocab} v ON f.space = v.space AND f.term = v.term),
{name} AS MATERIALIZED (
  SELECT space, {key}, term, CAST(tf AS INTEGER) AS tf,
         w / sqrt(sum(w * w) OVER (PARTITION BY space, {key})) AS weight FROM {name}_raw)"""


def cleaned(spark, sf_dir):
    """Prepared articles with their split, written once."""
    rows = split_groups(fx.prepared(spark, sf_dir))
    return materialize(
        rows.select("row_id", "label", "title", "content", "word_count", "clean", "split"), "articles"
    )


def fitted(rows):
    train = rows.filter(F.col("split") == "train")
    return ft.fit_features(train)


TRAIN = f"{fx.SPLIT}, train AS (SELECT * FROM split WHERE split = 'train')"
FITTED = f"{TRAIN}, {vocabulary_ctes('train')}"


@query(
    "tokens",
    f"""WITH {fx.PREPARED} SELECT row_id, CAST(len(t) AS INTEGER) AS n,
        sha256(array_to_string(t, ' ')) AS tokens_hash
        FROM (SELECT row_id, {tokens_sql()} AS t FROM prepared) x""",
)
def tokens(spark, sf_dir):
    found = fx.prepared(spark, sf_dir).select("row_id", tk.model_tokens(F.col("clean")).alias("t"))
    return found.select(
        "row_id", F.size("t").alias("n"), F.sha2(F.array_join("t", " "), 256).alias("tokens_hash")
    )


@query(
    "stopword_filter",
    f"""WITH {fx.PREPARED} SELECT term, count(*) AS total FROM (
          SELECT unnest({kept_sql()}) AS term FROM prepared) t GROUP BY 1""",
)
def stopword_filter(spark, sf_dir):
    words = tk.drop_stop_words(tk.model_tokens(F.col("clean")), _STOP)
    return (
        fx.prepared(spark, sf_dir)
        .select(F.explode_outer(words).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count("*").alias("total"))
    )


@query(
    "word_ngrams",
    f"""WITH {fx.PREPARED} SELECT term, count(*) AS total
        FROM ({word_terms_sql('prepared', 'row_id')}) t GROUP BY 1""",
)
def word_ngrams(spark, sf_dir):
    rows = ft.with_terms(fx.prepared(spark, sf_dir), ft.WORD_SPACE, "terms", FeatureOptions())
    terms = rows.select(F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("total"))


@query(
    "char_ngrams",
    f"""WITH {fx.PREPARED} SELECT term, count(*) AS total
        FROM ({char_terms_sql('prepared', 'row_id')}) t GROUP BY 1""",
)
def char_ngrams(spark, sf_dir):
    rows = ft.with_terms(fx.prepared(spark, sf_dir), ft.CHAR_SPACE, "terms", FeatureOptions())
    terms = rows.select(F.explode_outer("terms").alias("term")).filter(F.col("term").isNotNull())
    return terms.groupBy("term").agg(F.count("*").alias("total"))


@query(
    "vocabulary",
    f"""WITH {FITTED} SELECT space, term, CAST(total AS BIGINT) AS total, df, round(idf, 6) AS idf
        FROM vocab""",
)
def vocabulary(spark, sf_dir):
    train = cleaned(spark, sf_dir).filter(F.col("split") == "train")
    n = train.count()
    spaces = [
        ft.vocabulary(train, s, n).select(F.lit(s).alias("space"), "term", "total", "df")
        for s in (ft.WORD_SPACE, ft.CHAR_SPACE)
    ]
    idf = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1
    return spaces[0].unionByName(spaces[1]).withColumn("idf", r6(idf))


def _rows_sql(where: str) -> str:
    return f"""WITH {FITTED}, part AS (SELECT * FROM split WHERE {where}), {tfidf_ctes('part')}
SELECT row_id, space, term, tf, round(weight, 6) AS weight FROM tfidf"""


@query("tfidf", _rows_sql("split = 'train'"))
def tfidf(spark, sf_dir):
    rows = cleaned(spark, sf_dir)
    train = rows.filter(F.col("split") == "train")
    table = ft.tfidf_table(train, ft.fit_features(train), "row_id")
    return table.withColumn("weight", r6("weight"))


@query("tfidf_holdout", _rows_sql("split <> 'train'"))
def tfidf_holdout(spark, sf_dir):
    """Fitted on train, applied elsewhere: unseen terms drop out."""
    rows = cleaned(spark, sf_dir)
    table = ft.tfidf_table(rows.filter(F.col("split") != "train"), fitted(rows), "row_id")
    return table.withColumn("weight", r6("weight"))


@query(
    "feature_matrix",
    f"""WITH {FITTED}, {tfidf_ctes('split')}
        SELECT s.row_id, s.split, count(term) AS nnz, round(coalesce(sqrt(sum(weight * weight)), 0), 6) AS norm
        FROM split s LEFT JOIN tfidf f ON s.row_id = f.row_id GROUP BY 1, 2""",
)
def feature_matrix(spark, sf_dir):
    """Both spaces side by side in one sparse vector per row."""
    rows = cleaned(spark, sf_dir)
    vectors = ft.with_features(rows, fitted(rows))
    return ft.vector_stats(vectors, "features", "row_id", "split").withColumn("norm", r6("norm"))


_MERGED = f"""{fx.SPLIT}, merged AS (
  SELECT term, count(*) FILTER (NOT current) AS before, count(*) FILTER (current) AS after
  FROM (SELECT split <> 'train' AS current, unnest({tokens_sql()}) AS term FROM split) t GROUP BY term),
shares AS (
  SELECT *, before / nullif(sum(before) OVER (), 0) AS p, after / nullif(sum(after) OVER (), 0) AS q FROM merged),
parted AS (
  SELECT *, (CASE WHEN p = 0 THEN 0 ELSE p * log2(p / ((p + q) / 2)) END + CASE WHEN q = 0 THEN 0 ELSE q * log2(q / ((p + q) / 2)) END) / 2 AS drift
  FROM shares)"""


def _merged(spark, sf_dir):
    """Words of the training articles and of all others."""
    rows = split_groups(fx.prepared(spark, sf_dir)).withColumn("terms", tk.model_tokens(F.col("clean"), True))
    return materialize(drift.slice_terms(rows, "terms", F.col("split") != "train"), "drift")


@query(
    "vocab_drift",
    f"""WITH {_MERGED} SELECT count(*) FILTER (before > 0) AS reference_terms, count(*) FILTER (after > 0) AS current_terms,
        count(*) FILTER (before > 0 AND after > 0) AS shared_terms, round(sum(drift), 6) AS js_divergence,
        round(sum(after) FILTER (before = 0)::DOUBLE / sum(after), 6) AS unknown_tokens,
        round(count(*) FILTER (before = 0 AND after > 0)::DOUBLE / count(*) FILTER (after > 0), 6) AS unknown_terms FROM parted""",
)
def vocab_drift(spark, sf_dir):
    found = drift.vocabulary_drift(_merged(spark, sf_dir))
    rounded = {c: r6(c) for c in ("js_divergence", "unknown_tokens", "unknown_terms")}
    return found.withColumns(rounded)


@query(
    "vocab_drift_terms",
    f"""WITH {_MERGED} SELECT term, before, after, round(drift, 6) AS drift FROM parted ORDER BY round(parted.drift, 12) DESC, term LIMIT 30""",
)
def vocab_drift_terms(spark, sf_dir):
    return drift.drifting_terms(_merged(spark, sf_dir)).withColumn("drift", r6("drift"))
