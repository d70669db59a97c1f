"""Column contract, prepared table, load summary and table fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.config import SEPARATOR, TextOptions
from corpuslens.errors import DataContractError
from corpuslens.functions import text as tx
from corpuslens.functions.hashing import hash60

LABELS = (0, 1)


def validate(df: DataFrame, required: tuple[str, ...] = ("title", "text")) -> DataFrame:
    """Check columns on the schema and turn missing required text into empty strings."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise DataContractError(f"the table has no column {' or '.join(lacking)}")
    if "label" not in df.columns:
        raise DataContractError("the table has no column label, which holds 0 or 1")
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in required})


def validation_report(df: DataFrame, required: tuple[str, ...] = ("title", "text")) -> DataFrame:
    """One row: rows, missing values per required column, and rows per kind of label."""
    label = F.col("label")
    return df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in required],
        F.count_if(label.isNull()).alias("missing_label"),
        F.count_if(label.isNotNull() & ~label.isin(*LABELS)).alias("invalid_label"),
        *[F.count_if(label == k).alias(f"label_{k}") for k in LABELS],
    )


def check_labels(df: DataFrame) -> DataFrame:
    """Fail before any fit when a label lies outside {0, 1} (one small aggregate)."""
    bad = (
        df.filter(F.col("label").isNotNull() & ~F.col("label").isin(*LABELS))
        .select("label")
        .groupBy("label")
        .agg(F.count("*").alias("rows"))
        .agg(F.count("*").alias("kinds"), F.min("label").alias("low"), F.max("label").alias("high"), F.sum("rows").alias("rows"))
        .first()
    )
    if bad["kinds"]:
        raise DataContractError(
            f"{bad['rows']} rows have a label other than 0 and 1: {bad['kinds']} values from {bad['low']} to {bad['high']}"
        )
    return df


def add_content(df: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """Add ``content`` and ``word_count``."""
    return df.withColumn("content", tx.combine(F.col("title"), F.col("text"), separator)).withColumn(
        "word_count", tx.word_count(F.col("content"))
    )


def drop_empty(df: DataFrame, separator: str = SEPARATOR, count_separator: bool = True) -> DataFrame:
    """Keep rows with words. The separator token counts as one unless told otherwise.

    While it counts, every row has a word and nothing needs testing.
    """
    own = len(separator.split())
    if count_separator and own:
        return df
    return df.filter(F.col("word_count") > own)


def prepare(
    df: DataFrame,
    separator: str = SEPARATOR,
    options: TextOptions = TextOptions(),
    count_separator: bool = True,
) -> DataFrame:
    """Validated rows with content, word count, clean text, fingerprint and title group.

    Columns nobody reads are pruned together with the work behind them.
    """
    kept = drop_empty(add_content(validate(df), separator), separator, count_separator)
    named = tx.with_normalized(kept, {"content": "clean", "title": "__title"}, options)
    hashed = named.withColumn("document_hash", tx.fingerprint(F.col("clean")))
    group = tx.title_group(F.col("__title"), F.col("document_hash"))
    return hashed.withColumn("title_group", group).drop("__title")


def load_summary(
    raw: DataFrame, kept: DataFrame, stats: DataFrame, minimum_words: int = 8
) -> DataFrame:
    """One row of load accounting: raw rows, usable rows, short rows, classes, removals."""
    before = add_content(validate(raw)).agg(
        F.count("*").alias("raw_rows"),
        F.count_if(F.col("word_count") == 0).alias("empty_rows_removed"),
        F.count_if(F.col("word_count") < minimum_words).alias("short_rows_retained"),
    )
    after = kept.agg(
        F.count("*").alias("usable_rows"),
        *[F.count_if(F.col("label") == k).alias(f"class_{k}") for k in LABELS],
    )
    # Three one-row tables side by side.
    one = F.lit(1).alias("__one")
    return (
        before.select("*", one)
        .join(after.select("*", one), "__one")
        .join(stats.select("*", one), "__one")
        .drop("__one")
    )


def table_fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent fingerprint of a table: count, sum and xor of row hashes."""
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in sorted(df.columns)]
    hashed = df.select(hash60(F.concat_ws("\x1f", *cells)).alias("h"))
    return hashed.agg(
        F.count("*").alias("rows"),
        F.sum(F.col("h").cast("decimal(38,0)")).cast("string").alias("hash_sum"),
        F.bit_xor("h").alias("hash_xor"),
    )
