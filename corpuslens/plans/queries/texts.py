"""Normaliser steps and fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.config import TextOptions
from corpuslens.functions import text as tx
from corpuslens.functions import unicode as uni
from corpuslens.operators.contract import add_content, prepare
from corpuslens.plans.queries import fixtures as fx
from corpuslens.plans.queries.registry import query

_MARKED = f"WITH {fx.COLLECTION}, {fx.marked_sql('collection')}, " + (
    f"m AS (SELECT row_id, {fx.content_sql()} AS content FROM marked)"
)


def _marked(spark, sf_dir) -> DataFrame:
    return add_content(fx.marked(fx.collection(spark, sf_dir)))


def _digest(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Compare long texts by length and SHA-256."""
    df = df.withColumn("__value", value)
    return df.select(
        key,
        F.length("__value").cast("bigint").alias("n_chars"),
        F.sha2("__value", 256).alias("value_hash"),
    )


def _digest_sql(key: str, value: str, source: str) -> str:
    return (
        f"SELECT {key}, CAST(length(v) AS BIGINT) AS n_chars, sha256(v) AS value_hash "
        f"FROM (SELECT {key}, {value} AS v FROM {source}) t"
    )


def _step(name: str, step, sql) -> None:
    @query(name, f"{_MARKED} {_digest_sql('row_id', sql('content'), 'm')}")
    def run(spark, sf_dir, step=step):
        return _digest(_marked(spark, sf_dir), "row_id", step(F.col("content")))


_step("apostrophes", uni.straighten, fx.apostrophes_sql)
_step("mask_email", tx.mask_emails, fx.email_sql)
_step("strip_source_prefix", tx.strip_source_prefix, fx.prefix_sql)
_step("strip_source_marker", tx.strip_source_markers, fx.marker_sql)
_step(
    "contractions",
    lambda c: tx.expand_contractions(F.lower(uni.straighten(c))),
    lambda e: fx.contractions_sql(f"lower({fx.apostrophes_sql(e)})"),
)
_step(
    "collapse_repeats",
    lambda c: tx.collapse_repeats(F.lower(c)),
    lambda e: fx.repeats_sql(f"lower({e})"),
)
# ASCII word edges in the check SQL: texts keep ASCII letters around digits.
_step("mask_numbers", tx.mask_numbers, fx.numbers_sql)

_WIDE = "".join(chr(0xFF21 + i) for i in range(26)) + "".join(chr(0xFF41 + i) for i in range(26))
_PLAIN = "".join(chr(65 + i) for i in range(26)) + "".join(chr(97 + i) for i in range(26))


@query("nfkc", f"WITH {fx.COLLECTION} {_digest_sql('row_id', 'text', 'collection')}")
def nfkc(spark, sf_dir):
    """Texts are widened to full-width letters; decoding must give the original back."""
    wide = fx.collection(spark, sf_dir).withColumn("wide", F.translate("text", _PLAIN, _WIDE))
    return _digest(wide, "row_id", uni.decode(F.col("wide")))


_ENTITIES = "html"
for _name, _char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
    _ENTITIES = f"replace({_ENTITIES}, {fx.quote(_name)}, {fx.quote(_char)})"


@query("html_unescape", _digest_sql("page_id", _ENTITIES, "pages"))
def html_unescape(spark, sf_dir):
    return _digest(fx.table(spark, sf_dir, "pages"), "page_id", uni.decode(F.col("html")))


@query("strip_html", _digest_sql("page_id", fx.tags_sql("html"), "pages"))
def strip_html(spark, sf_dir):
    return _digest(fx.table(spark, sf_dir, "pages"), "page_id", tx.strip_tags(F.col("html")))


_LINK = "url || ' ' || html"


@query(
    "mask_url",
    "SELECT a.*, b.value_hash AS dropped_hash FROM "
    f"({_digest_sql('page_id', fx.url_sql(_LINK), 'pages')}) a JOIN "
    f"({_digest_sql('page_id', fx.url_sql(_LINK, ' '), 'pages')}) b ON a.page_id = b.page_id",
)
def mask_url(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages").withColumn("page", F.concat_ws(" ", "url", "html"))
    dropped = F.sha2(tx.drop_urls(F.col("page")), 256)
    return (
        pages.withColumns({"__value": tx.mask_urls(F.col("page")), "dropped_hash": dropped})
        .select(
            "page_id",
            F.length("__value").cast("bigint").alias("n_chars"),
            F.sha2("__value", 256).alias("value_hash"),
            "dropped_hash",
        )
    )


@query("normalize_text", f"{_MARKED} {_digest_sql('row_id', fx.normalize_sql('content'), 'm')}")
def normalize_text(spark, sf_dir):
    clean = tx.with_normalized(_marked(spark, sf_dir), {"content": "clean"})
    return _digest(clean, "row_id", F.col("clean"))


@query(
    "normalize_options",
    "SELECT row_id, CAST(length(v) AS BIGINT) AS n_chars, sha256(v) AS value_hash FROM ("
    f"SELECT row_id, {fx.keep_sql(fx.numbers_sql(fx.repeats_sql(fx.contractions_sql('lower(' + fx.url_sql(fx.email_sql(fx.tags_sql(fx.apostrophes_sql('content'))), ' ') + ')'))))} AS v "
    f"FROM ({_MARKED} SELECT * FROM m) q) t",
)
def normalize_options(spark, sf_dir):
    """Numbers masked, URLs dropped, source markers kept."""
    options = TextOptions(replace_urls=False, replace_numbers=True, remove_source_markers=False)
    clean = tx.with_normalized(_marked(spark, sf_dir), {"content": "clean"}, options)
    return _digest(clean, "row_id", F.col("clean"))


@query(
    "doc_fingerprint",
    f"WITH {fx.PREPARED} SELECT row_id, document_hash FROM prepared",
)
def doc_fingerprint(spark, sf_dir):
    return prepare(fx.articles(spark, sf_dir)).select("row_id", "document_hash")


@query(
    "title_group",
    f"WITH {fx.PREPARED} SELECT row_id, {fx.group_sql()} AS title_group FROM prepared",
)
def title_group(spark, sf_dir):
    return fx.prepared(spark, sf_dir).select("row_id", "title_group")


@query(
    "strip_accents",
    f"WITH {fx.COLLECTION} {_digest_sql('row_id', 'strip_accents(text)', 'collection')}",
)
def strip_accents(spark, sf_dir):
    return _digest(fx.collection(spark, sf_dir), "row_id", uni.strip_accents(F.col("text")))
