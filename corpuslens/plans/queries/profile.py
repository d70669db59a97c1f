"""Profile tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.operators import profile as pf
from corpuslens.operators.contract import add_content
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.leakage import grams_sql, report_words_sql
from corpuslens.plans.queries.registry import query
from corpuslens.sources.tables import materialize

_CONTENT = f"""{fx.ARTICLES},
c AS (SELECT *, {fx.content_sql()} AS content FROM articles),
a AS (SELECT *, CAST({fx.words_sql('content')} AS BIGINT) AS word_count FROM c)"""


def _articles(spark, sf_dir):
    return add_content(fx.articles(spark, sf_dir))


@query("eda_shape", f"WITH {_CONTENT} SELECT count(*) AS rows, 7 AS columns FROM a")
def eda_shape(spark, sf_dir):
    return pf.shape(_articles(spark, sf_dir))


_COLUMNS = ("row_id", "title", "text", "subject", "label")


@query(
    "eda_missing",
    f"""WITH {fx.COLLECTION}, gaps AS (
          SELECT row_id, CASE WHEN row_id % 11 = 0 THEN NULL ELSE title END AS title, text,
                 CASE WHEN row_id % 7 = 0 THEN NULL ELSE subject END AS subject, label
          FROM collection) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM gaps"
        for c in _COLUMNS
    ),
)
def eda_missing(spark, sf_dir):
    """On a raw table, where titles and subjects may be missing."""
    raw = fx.collection(spark, sf_dir).withColumns(
        {
            "title": F.when(F.col("row_id") % 11 != 0, F.col("title")),
            "subject": F.when(F.col("row_id") % 7 != 0, F.col("subject")),
        }
    )
    return pf.missing_values(raw)


@query(
    "eda_duplicates",
    f"""WITH {fx.COLLECTION}, gaps AS (
          SELECT CASE WHEN row_id % 11 <> 0 THEN title END AS title, CASE WHEN row_id % 7 <> 0 THEN text END AS text FROM collection)
        SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT title, text FROM gaps) d) AS BIGINT) AS duplicate_rows FROM gaps""",
)
def eda_duplicates(spark, sf_dir):
    """With titles and texts missing here and there."""
    raw = fx.collection(spark, sf_dir).withColumns(
        {"title": F.when(F.col("row_id") % 11 != 0, F.col("title")), "text": F.when(F.col("row_id") % 7 != 0, F.col("text"))}
    )
    return pf.duplicate_rows(raw)


@query("eda_classes", f"WITH {fx.ARTICLES} SELECT label, count(*) AS rows FROM articles GROUP BY 1")
def eda_classes(spark, sf_dir):
    return pf.class_distribution(fx.articles(spark, sf_dir))


_MEASURED = f"""{_CONTENT},
measured AS (
  SELECT label, CAST({fx.words_sql('title')} AS BIGINT) AS headline_words,
         CAST({fx.words_sql('text')} AS BIGINT) AS article_words, word_count,
         CAST(length(content) AS BIGINT) AS characters FROM a),
long AS (
  """ + " UNION ALL ".join(
    f"SELECT label, '{m}' AS measure, {m} AS v FROM measured" for m in pf.MEASURES
) + ")"


def _describe_sql(by: str = "") -> str:
    numbers = {
        "mean": "avg(v)",
        "std": "stddev_samp(v)",
        "min": "min(v)::DOUBLE",
        "p25": "quantile_cont(v, 0.25)",
        "p50": "quantile_cont(v, 0.5)",
        "p75": "quantile_cont(v, 0.75)",
        "max": "max(v)::DOUBLE",
    }
    columns = ", ".join(f"round_even({e}, 2) AS {n}" for n, e in numbers.items())
    return f"SELECT {by} measure, count(*) AS count, {columns} FROM long GROUP BY {by} measure"


@query("eda_lengths", f"WITH {_MEASURED} {_describe_sql()}")
def eda_lengths(spark, sf_dir):
    return pf.describe(pf.with_measures(_articles(spark, sf_dir)))


@query(
    "eda_lengths_by_label",
    f"WITH {_MEASURED} SELECT * FROM ({_describe_sql('label,')}) t WHERE measure = 'word_count'",
)
def eda_lengths_by_label(spark, sf_dir):
    return pf.describe(_articles(spark, sf_dir), ("word_count",), ("label",))


@query(
    "eda_length_sketch",
    f"""WITH {_MEASURED} SELECT label, measure, count(v) AS count, p AS probability, TRUE AS within
        FROM long, (VALUES (0.25::DOUBLE), (0.5::DOUBLE), (0.75::DOUBLE), (0.99::DOUBLE)) AS t(p) GROUP BY label, measure, p""",
)
def eda_length_sketch(spark, sf_dir):
    """Quantiles per class from sketches of parts, stored and merged; each value's exact rank is within 1 % of its probability."""
    measured = pf.with_measures(_articles(spark, sf_dir))
    parts = measured.withColumn("day", F.pmod(F.xxhash64("row_id"), F.lit(5)))
    stored = materialize(pf.sketch_lengths(parts, by=("label", "day")), "sketches")
    quantiles = pf.sketch_quantiles(pf.merge_sketches(stored, ("label",)), by=("label",))
    errors = pf.rank_errors(measured, quantiles, by=("label",))
    return errors.select("label", "measure", "count", "probability", (F.col("rank_error") <= 0.01).alias("within"))


def _ngrams_sql(n: int) -> str:
    grams = "t" if n == 1 else grams_sql("t", n)
    return f"""WITH {_CONTENT},
words AS (SELECT row_id, label, {report_words_sql()} AS t FROM a),
terms AS (SELECT row_id, label, unnest({grams}) AS term FROM words),
counted AS (SELECT label, term, count(*) AS total FROM terms GROUP BY 1, 2
            HAVING count(DISTINCT row_id) >= 2)
SELECT label, CAST(rank AS INTEGER) AS rank, term AS feature, total AS count FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY total DESC, term) AS rank FROM counted) r
WHERE rank <= 20"""


for _n, _name in ((1, "eda_unigrams"), (2, "eda_bigrams"), (3, "eda_trigrams")):

    @query(_name, _ngrams_sql(_n))
    def eda_ngrams(spark, sf_dir, n=_n):
        return pf.top_ngrams(_articles(spark, sf_dir), n)


@query(
    "eda_subjects",
    f"""WITH {fx.ARTICLES} SELECT label, subject, count(*) AS rows FROM articles GROUP BY 1, 2
        ORDER BY rows DESC, label, subject LIMIT 50""",
)
def eda_subjects(spark, sf_dir):
    return pf.subject_distribution(fx.articles(spark, sf_dir))


@query(
    "eda_dates",
    """SELECT round_even(avg(CASE WHEN o_orderkey % 7 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 4)
         AS valid_date_fraction,
       strftime(min(o_orderdate) FILTER (o_orderkey % 7 <> 0), '%Y-%m-%d') AS date_min,
       strftime(max(o_orderdate) FILTER (o_orderkey % 7 <> 0), '%Y-%m-%d') AS date_max
       FROM orders""",
)
def eda_dates(spark, sf_dir):
    """Order dates written out as text, every seventh one unreadable."""
    dates = fx.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, "unknown")
        .otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
        .alias("date")
    )
    profile = pf.date_profile(dates)
    return profile.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("date_min", "date_max")}
    )


@query(
    "eda_histogram",
    f"""WITH {_CONTENT},
clipped AS (SELECT label, least(word_count::DOUBLE, (SELECT quantile_cont(word_count, 0.99) FROM a)) AS v FROM a),
limits AS (SELECT label, min(v) - CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END::DOUBLE AS lo,
                  max(v) + CASE WHEN min(v) = max(v) THEN 0.5 ELSE 0 END::DOUBLE AS hi FROM clipped GROUP BY 1),
edges AS (SELECT label, i AS bin, lo + i * ((hi - lo) / 35) AS e0,
                 CASE WHEN i = 34 THEN 'Infinity'::DOUBLE ELSE lo + (i + 1) * ((hi - lo) / 35) END AS e1
          FROM limits, range(35) r(i))
SELECT e.label, CAST(bin AS INTEGER) AS bin, round(min(e0), 6) AS lower_edge, count(v) AS rows
FROM edges e LEFT JOIN clipped c ON c.label = e.label AND v >= e0 AND v < e1 GROUP BY 1, 2""",
)
def eda_histogram(spark, sf_dir):
    counted = pf.word_count_histogram(_articles(spark, sf_dir))
    return counted.select("label", "bin", F.round("lower_edge", 6).alias("lower_edge"), "rows")
