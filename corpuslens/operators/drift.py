"""Vocabulary drift between two slices of a collection.

Occurrences are counted by slice and term with map-side combining, then both sides of a term meet in one
aggregate, which is the full outer merge. Totals are a second, one-row aggregate; no term reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.operators.profile import term_totals


def slice_terms(df: DataFrame, terms: str, current: Column) -> DataFrame:
    """``term, before, after``: occurrences in rows where ``current`` is false and true; rows where it is null drop out."""
    marked = df.select(current.alias("__current"), terms).filter(F.col("__current").isNotNull())
    counted = term_totals(marked, terms, "__current")
    return counted.groupBy("term").agg(
        F.sum(F.when(F.col("__current"), 0).otherwise(F.col("total"))).alias("before"),
        F.sum(F.when(F.col("__current"), F.col("total")).otherwise(0)).alias("after"),
    )


def divergence(merged: DataFrame) -> DataFrame:
    """Add each term's share of the Jensen-Shannon divergence (base 2) as ``drift``, and its shares ``p`` and ``q``.

    A slice without terms has no distribution; ``p`` or ``q`` and ``drift`` are null then.
    """
    totals = merged.agg(F.sum("before").alias("__before"), F.sum("after").alias("__after"))
    rows = merged.crossJoin(F.broadcast(totals))  # one row
    p = F.col("before") / F.nullif(F.col("__before"), F.lit(0))
    q = F.col("after") / F.nullif(F.col("__after"), F.lit(0))
    rows = rows.withColumns({"p": p, "q": q})

    def part(share: str) -> Column:
        middle = (F.col("p") + F.col("q")) / 2
        return F.when(F.col(share) == 0, 0.0).otherwise(F.col(share) * F.log2(F.col(share) / middle))

    return rows.withColumn("drift", (part("p") + part("q")) / 2).drop("__before", "__after")


def vocabulary_drift(merged: DataFrame) -> DataFrame:
    """One row: sizes, shared terms, divergence, and how much of the current slice the reference does not know."""
    rows = divergence(merged)
    new = F.col("before") == 0
    return rows.agg(
        F.count_if(F.col("before") > 0).alias("reference_terms"),
        F.count_if(F.col("after") > 0).alias("current_terms"),
        F.count_if((F.col("before") > 0) & (F.col("after") > 0)).alias("shared_terms"),
        F.sum("drift").alias("js_divergence"),
        (F.sum(F.when(new, F.col("after")).otherwise(0)) / F.nullif(F.sum("after"), F.lit(0))).alias("unknown_tokens"),
        (F.count_if(new & (F.col("after") > 0)) / F.nullif(F.count_if(F.col("after") > 0), F.lit(0))).alias("unknown_terms"),
    )


def drifting_terms(merged: DataFrame, limit: int = 30) -> DataFrame:
    """Terms with the largest part in the divergence; ties go to the smaller term."""
    ranked = divergence(merged).orderBy(F.round("drift", 12).desc(), "term").limit(limit)
    return ranked.select("term", "before", "after", "drift")
