"""The document pipeline: toxicity, near duplicates, benchmark decontamination, packing.

Each stage takes the documents its predecessor kept; its result is written to the shared folder and read again.
All but the last return the columns of ``documents``. The last returns one row per packed piece.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.llm import decontaminate, neardup, packing, toxicity
from corpuslens.llm.common import fresh_name, table
from corpuslens.llm.queries import tokenizer_path
from corpuslens.sources.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, scored by a field fitted on them and their labels."""
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    into = fresh_name("toxicity", docs.columns)
    kept = tuple(docs.columns)
    scored = toxicity.score(docs, chain, keep=kept, into=into)
    return scored.where(F.col(f"{into}.score") < toxicity.THRESHOLD).select(*kept)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, and each row with a null id; of repeated rows one stays.

    Rows are told apart by id and text: an id that occurs with texts that do not resemble each other keeps them all.
    """
    rejected = neardup.near_duplicates(docs).where("NOT first").select("doc_id", "text_key").distinct()
    rejected = rejected.toDF("__id", "__key")
    named, nameless = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    named = named.withColumn("__text_key", neardup.text_key(F.col("text")))
    same = (F.col("doc_id").cast("long") == F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    kept = named.hint("merge").join(rejected, same, "left_anti").dropDuplicates(["doc_id", "__text_key"])
    return kept.drop("__text_key").unionByName(nameless)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose words are not to a twentieth or more benchmark windows."""
    into = fresh_name("contamination", docs.columns)
    kept = tuple(docs.columns)
    scanned = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), keep=kept, into=into)
    return scanned.where(~decontaminate.contaminated(into)).select(*kept)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents in sequences of 2048 tokens."""
    return packing.packed_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


#: The toxicity model and the tokenizer cannot be stated in SQL; tests check the stages by brute force.
ORACLE_SQL = None
