"""Leakage audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpuslens.functions.stopwords import ENGLISH
from corpuslens.operators import leakage as lk
from corpuslens.operators.contract import add_content
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query, r6

_MARKED = f"""{fx.ARTICLES}, {fx.marked_sql('articles')},
m AS (SELECT *, {fx.content_sql()} AS content FROM marked)"""

# The audited patterns, restated for DuckDB.
_HITS = {
    "reuters_marker": r"\breuters\b",
    "associated_press_marker": r"\bassociated press\b",
    "url": r"(?:https?://|www\.)",
    "copyright": r"\bcopyright\b",
    "date_pattern": (
        rf"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[{fx.WORD}]* [0-9]{{1,2}}, [0-9]{{4}}\b"
    ),
}


def _hit_sql(name: str) -> str:
    hit = f"regexp_matches(content, {fx.quote(_HITS[name])}, 'i')"
    removed = name in lk.REMOVED
    reason = lk.REMOVED_REASON if removed else lk.RETAINED_REASON
    return (
        f"SELECT '{name}' AS feature, count(*) FILTER ({hit} AND label = 0) AS fake_rows, "
        f"count(*) FILTER ({hit} AND label = 1) AS real_rows, {str(removed).lower()} AS removed, "
        f"{fx.quote(reason)} AS reason FROM m"
    )


STOP_SQL = "(" + ", ".join(fx.quote(w) for w in ENGLISH) + ")"


def report_words_sql(expr: str = "content") -> str:
    found = f"regexp_extract_all(lower({expr}), '[{fx.WORD}]{{2,}}')"
    return f"list_filter({found}, lambda t: t NOT IN {STOP_SQL})"


def grams_sql(tokens: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{tokens}[i + {k}]" if k else f"{tokens}[i]" for k in range(n))
    return f"list_transform(range(1, len({tokens}) - {n - 2}), lambda i: {parts})"


def _marked(spark, sf_dir):
    return add_content(fx.marked(fx.articles(spark, sf_dir)))


@query("leak_patterns", f"WITH {_MARKED} " + " UNION ALL ".join(_hit_sql(n) for n in _HITS))
def leak_patterns(spark, sf_dir):
    return lk.known_patterns(_marked(spark, sf_dir))


_DF = f"""{_MARKED},
words AS (SELECT row_id, label, {report_words_sql()} AS t FROM m),
terms AS (SELECT DISTINCT row_id, label, unnest(list_concat(t, {grams_sql('t', 2)})) AS term FROM words),
counted AS (
  SELECT term, count(*) FILTER (label = 0) AS fake_documents,
         count(*) FILTER (label = 1) AS real_documents, count(*) AS n
  FROM terms GROUP BY term HAVING count(*) >= 10 ORDER BY n DESC, term LIMIT 25000)"""


@query("leak_term_df", f"WITH {_DF} SELECT term, fake_documents, real_documents FROM counted")
def leak_term_df(spark, sf_dir):
    return lk.term_frequencies(_marked(spark, sf_dir))


@query(
    "leak_terms",
    f"""WITH {_DF}, shares AS (
          SELECT *, CAST(real_documents + 1 AS DOUBLE) / (n + 2) AS share FROM counted)
        SELECT term AS feature, fake_documents, real_documents,
          round_even(share, 4) AS real_share_smoothed,
          round(abs(share - 0.5) * ln(1 + n), 9) AS association,
          '{lk.REVIEW_STATUS}' AS review_status
        FROM shares ORDER BY association DESC, feature LIMIT 30""",
)
def leak_terms(spark, sf_dir):
    return lk.associated_terms(lk.term_frequencies(_marked(spark, sf_dir)))


@query(
    "leak_mitigation",
    f"""WITH {fx.ARTICLES} SELECT (SELECT count(*) FROM articles) AS audited_rows, CAST(position AS INTEGER) AS position, statement
        FROM (VALUES {", ".join(f"({i}, {fx.quote(s)})" for i, s in enumerate(lk.MITIGATION, 1))}) v(position, statement)""",
)
def leak_mitigation(spark, sf_dir):
    """Report statements next to the audited row count."""
    rows = fx.articles(spark, sf_dir).agg(F.count("*").alias("audited_rows"))
    notes = [F.struct(F.lit(i).alias("position"), F.lit(s).alias("statement"))
             for i, s in enumerate(lk.MITIGATION, 1)]
    return rows.select("audited_rows", F.inline(F.array(*notes)))


@query("leak_benchmark")
def leak_benchmark(spark, sf_dir):
    """Validation quality of logistic regression with agency markers kept and removed."""
    from corpuslens.plans.train import leakage_benchmark

    marked = fx.marked(fx.articles(spark, sf_dir))
    result = leakage_benchmark(marked)
    return result.select("variant", r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))
