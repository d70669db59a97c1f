"""Duplicate removal with accounting.

Everything is decided on a narrow table (id, label, two digests). Copies collapse map-side before
either exchange, so a text that makes up a third of the table costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.errors import DataContractError
from corpuslens.functions.hashing import fields_digest
from corpuslens.sources.tables import materialize

# Ids that may be broadcast to drop duplicates without shuffling the wide table.
BROADCAST_IDS = 4_000_000


def exact_key() -> Column:
    """Digest of (title, text, label)."""
    return fields_digest(F.col("title"), F.col("text"), F.col("label"))


def first_per_key(df: DataFrame, key: Column) -> DataFrame:
    """Smallest ``row_id`` per key."""
    return df.groupBy(key.alias("__key")).agg(F.min("row_id").alias("row_id")).select("row_id")


def exact_survivors(df: DataFrame) -> DataFrame:
    """Ids kept when (title, text, label) repeats: the first of each."""
    return first_per_key(df, exact_key())


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    """The narrow table that decides, and further columns."""
    own = {
        "row_id": F.col("row_id"),
        "label": F.col("label"),
        "digest": F.unhex("document_hash").alias("digest"),
        "exact": exact_key().alias("exact"),
    }
    return df.select(*own.values(), *[c for c in columns if c not in own])


def hash_groups(df: DataFrame) -> DataFrame:
    """One row per document hash: rows, distinct exact keys, label conflict, first id."""
    return groups_of(keyed(df))


def groups_of(narrow: DataFrame) -> DataFrame:
    per_exact = narrow.groupBy("digest", "exact").agg(
        F.count("*").alias("n"),
        F.min("row_id").alias("row_id"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    return per_exact.groupBy("digest").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("keys"),
        F.min("row_id").alias("row_id"),
        F.coalesce(F.min("low") != F.max("high"), F.lit(False)).alias("conflict"),
    )


def survivors(groups: DataFrame) -> DataFrame:
    """Ids that remain after all three removals."""
    return groups.filter(~F.col("conflict")).select("row_id")


def contradictory_hashes(groups: DataFrame) -> DataFrame:
    return groups.filter("conflict").select(F.lower(F.hex("digest")).alias("document_hash"))


def dedup_stats(groups: DataFrame) -> DataFrame:
    """Rows removed by each of the three steps, in their order."""
    keys, conflict = F.col("keys"), F.col("conflict")

    def total(c: Column, name: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)

    return groups.agg(
        total(F.col("n") - keys, "exact_duplicates_removed"),
        total(F.when(~conflict, keys - 1).otherwise(0), "normalized_duplicates_removed"),
        total(F.when(conflict, keys).otherwise(0), "contradictory_duplicate_rows_removed"),
    )


def keep_ids(df: DataFrame, kept: DataFrame, removed_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose id is in ``kept``.

    With few removals the complement is computed on ids alone and broadcast, so the wide table is
    never shuffled. Otherwise both sides shuffle on the (unique, evenly spread) id.
    """
    if removed_rows is not None and removed_rows <= BROADCAST_IDS:
        removed = df.select("row_id").join(kept, "row_id", "left_anti")
        return df.join(F.broadcast(removed), "row_id", "left_anti")
    return df.join(kept, "row_id", "left_semi")


def remove_duplicates(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """Surviving rows and the accounting row. The narrow group table is written once.

    Ids decide which copy is the first, so rows without an id are refused. Where only some columns (``row_id`` among
    them) are wanted, they are computed and stored together with the keys, instead of normalising the texts once more.
    """
    if not df.filter(F.col("row_id").isNull()).isEmpty():
        raise DataContractError("row_id holds nulls")
    narrow = keyed(df, *columns)
    if columns:
        narrow = materialize(narrow, "keyed")
        df = narrow.select(*columns)
    groups = materialize(groups_of(narrow), "hash-groups")
    stats = dedup_stats(groups)
    counts = stats.first()
    return keep_ids(df, survivors(groups), sum(counts)), stats
