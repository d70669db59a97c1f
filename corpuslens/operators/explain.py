"""Local and global explanations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.operators.features import WORD_SPACE
from corpuslens.operators.score import TextModel, with_scores


def local_terms(df: DataFrame, model: TextModel, top_n: int = 8, *keep: str) -> DataFrame:
    """One line per explained term: direction, rank, term and absolute contribution."""

    def lines(side: str) -> Column:
        return F.transform(
            f"scored.toward_{side}",
            lambda item, i: F.struct(
                F.lit(side).alias("direction"),
                (i + 1).alias("rank"),
                item["feature"].alias("feature"),
                item["contribution"].alias("contribution"),
            ),
        )

    scored = with_scores(df, model, top_n)
    both = scored.select(*keep, F.inline_outer(F.concat(lines("fake"), lines("real"))))
    return both.filter(F.col("feature").isNotNull())


def coefficient_table(spark: SparkSession, model: TextModel) -> DataFrame:
    """(member, space, term, coefficient); bounded by the vocabulary caps."""
    schema = pa.schema(
        [
            ("member", pa.int32()),
            ("space", pa.string()),
            ("term", pa.string()),
            ("coefficient", pa.float64()),
        ]
    )
    parts = [schema.empty_table()]
    for number, m in enumerate(model.members):
        if m.linear.explainable:
            spaces, terms = zip(*m.features.names) if m.features.names else ((), ())
            member = np.full(len(terms), number, dtype=np.int32)
            columns = [member, list(spaces), list(terms), m.linear.coefficients]
            parts.append(pa.table([pa.array(c) for c in columns], schema=schema))
    return spark.createDataFrame(pa.concat_tables(parts))


def global_terms(
    spark: SparkSession, model: TextModel, top_n: int = 20, average_ensemble: bool = False
) -> DataFrame:
    """Strongest word coefficients toward each class.

    Calibrated ensembles publish none unless their coefficients are averaged on request.
    """
    table = coefficient_table(spark, model).filter(F.col("space") == WORD_SPACE)
    if model.calibrated and not average_ensemble:
        table = table.limit(0)
    return strongest_coefficients(
        table.groupBy("term").agg(F.avg("coefficient").alias("coefficient")), top_n
    )


def strongest_coefficients(table: DataFrame, top_n: int = 20) -> DataFrame:
    """Two top-k lists of a (term, coefficient) table."""
    weight = F.col("coefficient")
    fake = table.orderBy(weight.asc(), F.col("term")).limit(top_n)
    real = table.orderBy(weight.desc(), F.col("term")).limit(top_n)
    return fake.withColumn("class", F.lit("fake")).unionByName(
        real.withColumn("class", F.lit("real"))
    )


def contribution_table(terms: DataFrame, *keep: str) -> DataFrame:
    """Display form of explained terms, strengths rounded to 4 decimals."""
    return terms.select(
        *keep,
        F.col("feature").alias("word_or_phrase"),
        F.bround("contribution", 4).alias("contribution_strength"),
        "direction",
    )
