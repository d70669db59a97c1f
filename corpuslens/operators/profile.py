"""Profile tables of a prepared collection.

Distributions are first counted per value (map-side combined); everything else reads the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions import text as tx
from corpuslens.functions import tokens as tk
from corpuslens.functions.dates import parse_date
from corpuslens.functions.hashing import fields_digest
from corpuslens.functions.stopwords import ENGLISH

MEASURES = ("headline_words", "article_words", "word_count", "characters")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, dtype string")


def missing_values(df: DataFrame) -> DataFrame:
    """Null count per column, in one pass."""
    names = df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    lines = [F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in names]
    return wide.select(F.inline(F.array(*lines)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each (title, text)."""
    groups = df.groupBy(fields_digest(F.col("title"), F.col("text")).alias("k")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(F.count("*").alias("rows"))


def with_measures(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "headline_words": tx.word_count(F.coalesce("title", F.lit(""))),
            "article_words": tx.word_count(F.coalesce("text", F.lit(""))),
            "characters": F.length(F.coalesce("content", F.lit(""))),
        }
    )


def describe(
    df: DataFrame, measures: tuple[str, ...] = MEASURES, by: tuple[str, ...] = ()
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per measure (2 decimals)."""
    lines = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("value"))
        for m in measures
    ]
    counted = (
        df.select(*by, F.inline(F.array(*lines)))
        .groupBy(*by, "measure", "value")
        .agg(F.count("*").alias("n"))
    )
    value, n = F.col("value"), F.col("n")
    rows = F.sum(n)
    mean = F.sum(value * n) / rows
    spread = F.sum(value.cast("double") * value * n) - rows * mean * mean
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n)
    summary = counted.groupBy(*by, "measure").agg(
        rows.alias("count"),
        mean.alias("mean"),
        F.when(rows > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (rows - 1))).alias("std"),
        F.min(value).cast("double").alias("min"),
        quartiles.alias("q"),
        F.max(value).cast("double").alias("max"),
    )
    numbers = {
        "mean": F.col("mean"),
        "std": F.col("std"),
        "min": F.col("min"),
        "p25": F.col("q")[0],
        "p50": F.col("q")[1],
        "p75": F.col("q")[2],
        "max": F.col("max"),
    }
    return summary.select(
        *by, "measure", "count", *[F.bround(c, 2).alias(name) for name, c in numbers.items()]
    )


#: Size of a quantile sketch; its rank error is about 2.3 / k^0.9 in 99 of 100 sketches.
SKETCH_K = 1024


def sketch_lengths(
    df: DataFrame, measures: tuple[str, ...] = MEASURES, by: tuple[str, ...] = (), k: int = SKETCH_K
) -> DataFrame:
    """One mergeable quantile sketch (KLL) per group and measure: a few kilobytes whatever the number of values.

    ``describe`` counts every distinct value and is exact; this is for measures with very many of them, and for tables
    that grow: sketches of parts can be stored and merged later. Nulls are not counted.
    """
    lines = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("value"))
        for m in measures
    ]
    values = df.select(*by, F.inline(F.array(*lines)))
    return values.groupBy(*by, "measure").agg(
        F.count("value").alias("count"), F.kll_sketch_agg_bigint("value", F.lit(k)).alias("sketch")
    )


def merge_sketches(sketches: DataFrame, by: tuple[str, ...] = (), k: int = SKETCH_K) -> DataFrame:
    """Sketches of parts (days, splits, batches) as one per group and measure."""
    return sketches.groupBy(*by, "measure").agg(
        F.sum("count").alias("count"), F.kll_merge_agg_bigint("sketch", F.lit(k)).alias("sketch")
    )


def sketch_quantiles(
    sketches: DataFrame, probabilities: tuple[float, ...] = (0.25, 0.5, 0.75, 0.99), by: tuple[str, ...] = ()
) -> DataFrame:
    """One row per sketch and probability: count, probability, value (null where nothing was counted)."""
    # the function takes literal ranks, one call each
    cells = [
        F.struct(F.lit(p).alias("probability"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(p)).alias("value"))
        for p in probabilities
    ]
    some = sketches.where("count > 0").select(*by, "measure", "count", F.inline(F.array(*cells)))
    none = sketches.where("count = 0").select(
        *by, "measure", "count", F.explode(F.array(*map(F.lit, probabilities))).alias("probability"), F.lit(None).cast("bigint").alias("value")
    )
    return some.unionByName(none)


def rank_errors(
    df: DataFrame, quantiles: DataFrame, measures: tuple[str, ...] = MEASURES, by: tuple[str, ...] = ()
) -> DataFrame:
    """``quantiles`` with the distance of each value's exact ranks from the probability, as a share of the rows.

    Values are counted first; ``quantiles`` (a few rows for each group) is broadcast against the counts.
    """
    lines = [
        F.struct(F.lit(m).alias("measure"), F.col(m).cast("bigint").alias("x")) for m in measures
    ]
    counted = df.select(*by, F.inline(F.array(*lines))).where("x IS NOT NULL").groupBy(*by, "measure", "x").agg(F.count("*").alias("n"))
    met = counted.join(F.broadcast(quantiles), [*by, "measure"])
    below, upto = F.sum(F.when(F.col("x") < F.col("value"), F.col("n")).otherwise(0)), F.sum(F.when(F.col("x") <= F.col("value"), F.col("n")).otherwise(0))
    ranks = met.groupBy(*by, "measure", "count", "probability", "value").agg(below.alias("below"), upto.alias("upto"))
    p, n = F.col("probability"), F.col("count")
    return ranks.select(
        *by, "measure", "count", "probability", "value",
        F.greatest(F.col("below") / n - p, p - F.col("upto") / n, F.lit(0.0)).alias("rank_error"),
    )


def top_ngrams(
    df: DataFrame,
    n: int,
    *,
    limit: int = 20,
    minimum_df: int = 2,
    stop_words: tuple[str, ...] = ENGLISH,
) -> DataFrame:
    """Most frequent n-grams per class among those found in at least ``minimum_df`` documents.

    A document emits each occurrence and, once per distinct term, a document mark; both add up in
    one map-side combined aggregate, without a shuffle by document.
    """
    words = tk.drop_stop_words(tk.report_tokens(F.col("content")), stop_words)
    grams = df.select("label", words.alias("words")).select(
        "label", tk.ngrams(F.col("words"), n).alias("terms")
    )
    counted = term_totals(grams, "terms", "label")
    order = Window.partitionBy("label").orderBy(F.col("total").desc(), F.col("term"))
    return (
        counted.filter(F.col("df") >= minimum_df)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
        .select("label", "rank", F.col("term").alias("feature"), F.col("total").alias("count"))
    )


def term_totals(df: DataFrame, terms: str, *by: str) -> DataFrame:
    """``total`` occurrences and ``df`` documents per term (and per ``by``), one exchange."""

    def mark(column, occurrence: int, document: int):
        return F.transform(
            column,
            lambda t: F.struct(
                t.alias("term"), F.lit(occurrence).alias("occ"), F.lit(document).alias("doc")
            ),
        )

    both = F.concat(mark(F.col(terms), 1, 0), mark(F.array_distinct(F.col(terms)), 0, 1))
    # The outer generator: a plain one adds a "not empty" filter below, where Spark would inline and
    # repeat the whole chain that builds the array.
    return (
        df.select(*by, F.inline_outer(both))
        .filter(F.col("term").isNotNull())
        .groupBy(*by, "term")
        .agg(F.sum("occ").alias("total"), F.sum("doc").alias("df"))
    )


def subject_distribution(df: DataFrame, limit: int = 50) -> DataFrame:
    return (
        df.groupBy("label", "subject")
        .agg(F.count("*").alias("rows"))
        .orderBy(F.col("rows").desc(), "label", "subject")
        .limit(limit)
    )


def date_profile(df: DataFrame, date: str = "date") -> DataFrame:
    """Share of parsable dates (4 decimals) and their range."""
    moment = parse_date(F.col(date))
    return df.select(moment.alias("m")).agg(
        F.bround(F.avg(F.col("m").isNotNull().cast("double")), 4).alias("valid_date_fraction"),
        F.min("m").alias("date_min"),
        F.max("m").alias("date_max"),
    )


def word_count_histogram(df: DataFrame, bins: int = 35, clip_at: float = 0.99) -> DataFrame:
    """Word counts per class, clipped at a global percentile, in equal bins of the class range.

    Bins are half-open, the last one closed. Only the table of distinct counts is revisited.
    """
    counted = df.groupBy("label", F.col("word_count").cast("double").alias("value")).agg(
        F.count("*").alias("n")
    )
    one = F.lit(1).alias("__one")
    ceiling = counted.agg(F.percentile("value", F.lit(clip_at), F.col("n")).alias("ceiling"))
    clipped = counted.select("*", one).join(F.broadcast(ceiling.select("*", one)), "__one")
    clipped = clipped.select("label", "n", F.least("value", "ceiling").alias("value"))
    # One row per label, a domain of two values; a constant class gets a bin range of width one.
    flat = F.when(F.min("value") == F.max("value"), 0.5).otherwise(0.0)
    limits = clipped.groupBy("label").agg(
        (F.min("value") - flat).alias("low"), (F.max("value") + flat).alias("high")
    )
    low, step = F.col("low"), F.col("step")
    guess = F.least(F.floor((F.col("value") - low) / step), F.lit(bins - 1))
    placed = (
        clipped.join(F.broadcast(limits), "label")
        .withColumn("step", (F.col("high") - low) / bins)
        .withColumn("guess", guess.cast("int"))
    )
    spot = F.col("guess")
    exact = (
        F.when(F.col("value") < low + spot * step, spot - 1)
        .when((spot < bins - 1) & (F.col("value") >= low + (spot + 1) * step), spot + 1)
        .otherwise(spot)
    )
    filled = placed.withColumn("bin", exact).groupBy("label", "bin").agg(F.sum("n").alias("rows"))
    # every bin of every class, empty ones too: two labels times a fixed number of bins
    every = limits.select(
        "label", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
        "low", ((F.col("high") - F.col("low")) / bins).alias("step"),
    )
    return every.join(filled, ["label", "bin"], "left").select(
        "label", "bin", (F.col("low") + F.col("bin") * F.col("step")).alias("lower_edge"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )
