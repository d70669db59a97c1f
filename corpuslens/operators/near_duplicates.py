"""Classes of near-duplicate articles: an exact set-similarity join on word shingles.

Rows with equal shingle sets are one class from the start, so copies cost one row. Classes are compared only if they share a
shingle of their prefixes, which are the rarest shingles that any similar set must share, and if sizes and positions allow the
similarity. Similar classes need no link of their own once others connect them, so links are sought twice:

1. Each class meets the smallest class of every prefix shingle: as many candidates as prefix entries, whatever the group's size.
2. Where a prefix shingle still joins different components, classes of different components meet.

Shingles are 64-bit hashes, computed again in each pass over the texts: stored, they would take more room than the texts. Whole sets
are kept only of classes that are candidates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.functions.grams import RUN_WORDS, runs, sizes_of
from corpuslens.functions.memory import trim
from corpuslens.operators.dedup import BROADCAST_IDS
from corpuslens.sources.tables import materialize

PERCENT = 92
WORDS = 5
#: Shingles are ordered by how often those with the same highest bits occur: enough to tell a shingle of a thousandth of all texts.
FREQUENCY_BITS = 18

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
STEP = np.uint64(0x9E3779B97F4A7C15)


def hashed_words(df: DataFrame, text: Column) -> DataFrame:
    """row_id and the hashes of the text's words. A-Z are lowered, words end at ASCII white space; nulls have none."""
    lowered = df.select("row_id", F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER).alias("text"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    return lowered.select("row_id", F.transform(words, lambda word: F.xxhash64(word)).alias("words"))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEP
    return x ^ (x >> np.uint64(29))


def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``RUN_WORDS`` words at a time: hashing holds several arrays of their size."""
    try:
        for batch in batches:
            for start, rows in runs(sizes_of(batch.column("words")), RUN_WORDS):
                yield batch.slice(start, rows)
    finally:
        trim()


def shingle_sets(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each row; fewer words than ``words`` are one shingle, no words none."""
    column = batch.column("words")
    offsets = column.offsets.to_numpy()
    flat = column.values[offsets[0] : offsets[-1]].to_numpy().astype("uint64")
    offsets = offsets - offsets[0]
    whole = np.zeros(max(len(flat) - words + 1, 0), "uint64")
    for k in range(words):
        whole = mixed(whole + flat[k : k + len(whole)] + STEP)
    for first, last in zip(offsets.tolist(), offsets[1:].tolist()):
        if last - first >= words:
            yield np.unique(whole[first : last - words + 1])
        elif last > first:
            short = np.array([last - first], "uint64")
            for at in range(first, last):
                short = mixed(short + flat[at : at + 1] + STEP)
            yield short
        else:
            yield np.empty(0, "uint64")


def place(shingles: np.ndarray, bits: int) -> np.ndarray:
    return (shingles >> np.uint64(64 - bits)).astype("int64")


def frequencies(hashed: DataFrame, words: int, bits: int) -> np.ndarray:
    """How often shingles of each of ``2**bits`` ranges occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, "int64")
        for batch in bounded(batches):
            found = list(shingle_sets(batch, words))
            if found:
                counts += np.bincount(place(np.concatenate(found), bits), minlength=1 << bits)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["place", "n"])

    found = hashed.mapInArrow(run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << bits, "int64")
    counts[found.column("place").to_numpy()] = found.column("n").to_numpy()
    return counts


def marked(hashed: DataFrame, percent: int, words: int, bits: int) -> DataFrame:
    """row_id, size, digest of the set, and its prefix: as many of the rarest shingles as leave too few for the similarity."""
    order = hashed.sparkSession.sparkContext.broadcast(frequencies(hashed, words, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            sizes, digests, prefixes = [], [], []
            for own in shingle_sets(batch, words):
                needed = -(-percent * len(own) // 100)
                rare = np.lexsort((own, order.value[place(own, bits)]))[: len(own) - needed + 1]
                sizes.append(len(own))
                digests.append(hashlib.sha256(own.tobytes()).digest()[:16])
                prefixes.append(own[rare].astype("int64"))
            columns = [batch.column("row_id"), pa.array(sizes, pa.int32()), pa.array(digests, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "size", "digest", "prefix"])

    return hashed.mapInArrow(run, "row_id bigint, size int, digest binary, prefix array<bigint>")


def sets_of(pairs: DataFrame, rows: DataFrame, df: DataFrame, text: Column, words: int) -> DataFrame:
    """digest and shingles of the classes that occur in pairs; only texts of their first ids are read."""
    wanted = materialize(pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct(), "wanted")
    ids = materialize(rows.select("row_id", "digest").join(wanted, "digest").groupBy("digest").agg(F.min("row_id").alias("wanted_id")).select("wanted_id").distinct(), "wanted-ids")
    small = ids.count() <= BROADCAST_IDS
    ids = F.broadcast(ids) if small else ids
    chosen = df.select("row_id", text.alias("text")).join(ids, F.col("row_id").eqNullSafe(F.col("wanted_id")), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            found = list(shingle_sets(batch, words))
            digests = [hashlib.sha256(own.tobytes()).digest()[:16] for own in found]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array([s.astype("int64") for s in found], pa.list_(pa.int64()))], names=["digest", "shingles"])

    sets = hashed_words(chosen, F.col("text")).mapInArrow(run, "digest binary, shingles array<bigint>")
    return materialize(sets.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("shingles").alias("shingles")), "sets")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of digests whose whole sets are similar enough."""
    joined = pairs.join(sets.toDF("a", "of_a"), "a").join(sets.toDF("b", "of_b"), "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return joined.where(100 * common >= percent * union).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """digest, root: the smallest digest that links lead to, for every linked digest."""
    both = materialize(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("digest")).agg(F.min("b").alias("near")).select("digest", F.least("digest", "near").alias("root")), "labels")
    while True:
        near = both.join(labels.select(F.col("digest").alias("b"), "root"), "b").groupBy(F.col("a").alias("digest")).agg(F.min("root").alias("near"))
        better = labels.join(near, "digest").select("digest", "root", F.least("root", "near").alias("next"))
        # a root's own root is as good, and halves what is left to go
        jumped = better.join(labels.select(F.col("digest").alias("next"), F.col("root").alias("beyond")), "next")
        found = materialize(jumped.select("digest", F.least("next", "beyond").alias("root"), (F.col("root") != F.least("next", "beyond")).alias("moved")), "labels")
        labels = found.select("digest", "root")
        if found.where("moved").isEmpty():
            return labels


def possible(percent: int) -> Column:
    """Whether sizes and positions of two prefix entries x and y of one shingle allow the similarity.

    The first shingle that two prefixes share has all that the sets share at or behind it.
    """
    size_a, size_b = F.col("x.size"), F.col("y.size")
    reachable = F.least(size_a - F.col("x.at"), size_b - F.col("y.at"))
    return (100 * F.least(size_a, size_b) >= percent * F.greatest(size_a, size_b)) & ((100 + percent) * reachable >= percent * (size_a + size_b))


def met(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct()


def to_heads(entries: DataFrame, percent: int) -> DataFrame:
    """Each class with the smallest class of each of its prefix shingles: at most as many pairs as entries."""
    heads = entries.groupBy("shingle").agg(F.min(F.struct("size", "digest", "at")).alias("head"), F.count("*").alias("n")).where("n > 1")
    heads = heads.select("shingle", "head.*").alias("y")
    return met(entries.alias("x").join(heads, "shingle").where((F.col("x.digest") != F.col("y.digest")) & possible(percent)))


def across(entries: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Classes of different components that share a prefix shingle; shingles of one component only are left out first."""
    placed = entries.join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    several = placed.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("shingle")
    placed = materialize(placed.join(several, "shingle"), "open")
    apart = (F.col("x.digest") < F.col("y.digest")) & (F.col("x.root") != F.col("y.root"))
    return met(placed.alias("x").join(placed.alias("y"), "shingle").where(apart & possible(percent)))


def near_duplicates(df: DataFrame, text: Column, percent: int = PERCENT, words: int = WORDS, bits: int = FREQUENCY_BITS) -> DataFrame:
    """row_id, n_shingles, class_id (smallest row_id that links of at least ``percent`` % similarity lead to), kept.

    One row per input row. Texts without words are linked with nothing and are a class of their own each. Repeated ids are judged
    by each row's text; a null id is never the class id unless all ids of its class are null. Other columns are not read.
    """
    df = df.withColumn("row_id", F.col("row_id").cast("bigint"))
    rows = materialize(marked(hashed_words(df, text), percent, words, bits), "marked")
    full = rows.where("size > 0")
    classes = materialize(full.groupBy("digest").agg(F.first("size").alias("size"), F.first("prefix").alias("prefix")), "classes")
    entries = classes.select("digest", "size", F.posexplode("prefix").alias("at", "shingle"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs, "candidates")
        return materialize(similar(pairs, sets_of(pairs, rows, df, text, words), percent), "links")

    first = confirmed(to_heads(entries, percent))
    second = confirmed(across(entries, components(first), percent))
    roots = components(first.unionByName(second))
    grouped = full.select("row_id", "size", "digest").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    least = grouped.groupBy("root").agg(F.min("row_id").alias("class_id"))
    linked = grouped.join(least, "root").select("row_id", "size", "class_id")
    alone = rows.where("size = 0").select("row_id", "size", F.col("row_id").alias("class_id"))
    return linked.unionByName(alone).select(
        "row_id", F.col("size").cast("bigint").alias("n_shingles"), "class_id", F.coalesce(F.col("row_id") == F.col("class_id"), F.lit(False)).alias("kept")
    )
