"""Near-duplicate groups: SuperMinHash, banding, exact verification, union-find.

1. ``sketches``: per document the size and a digest of its shingle set and one key per band.
2. Equal sets form one class before anything is compared. Its key is the digest, so rows with one id and different
   texts stay apart; its text is that of its smallest (id, text key).
3. Classes that share a band key meet in a bucket. Buckets with the same members are compared once. Only
   members of such buckets fetch their text again.
4. Inside a bucket all sets are compared exactly, by sparse counting in numpy. What leaves the task is a
   spanning forest of the links, never the pairs. A bucket of more than ``block_rows`` members or
   ``BLOCK_SHINGLES`` shingles is cut into blocks, and each pair of blocks is a task's share, so no group has to fit into one task.
5. Union-find: each partition contracts its edges, then the smallest label spreads until nothing changes.

Banding may miss a link of similarity s with probability (1 - s^rows)^bands; at 0.85 with 24 bands of 6
rows that is 1.2e-5. Confirmed links compare full sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import arrow_schema, fields, lean, slices, space_words, utf8
from corpuslens.llm.superminhash import shingle_sets, signatures
from corpuslens.sources.tables import materialize

WIDTH = 5
#: A link: 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 24, 6
BLOCK_ROWS = 512
BLOCK_SHINGLES = 1 << 20

SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text_key", T.BinaryType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def text_key(text: Column) -> Column:
    """128 bits of the text's SHA-256; a null text counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def sketches(docs: DataFrame, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, text key, n_shingles, digest of the set, band keys; digest and keys are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = arrow_schema(SKETCH)
        for batch in slices(batches, "__text"):
            sets = shingle_sets([space_words(data or b"") for data in utf8(batch.column("__text"))], width)
            signed = signatures(sets, bands * rows)
            keys = np.stack([fold(signed[:, b * rows : (b + 1) * rows], b) for b in range(bands)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("text_key").cast(pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([k if len(s) else None for s, k in zip(sets, keys)], pa.list_(pa.int64())),
                ],
                schema=target,
            )

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"), F.col("text").alias("__text"))
    return read.mapInArrow(lean(run), SKETCH)


def fold(values: np.ndarray, band: int) -> np.ndarray:
    """One 64-bit key of the slots of a band."""
    from corpuslens.llm.superminhash import MULTIPLIER, mix

    key = np.full(len(values), np.uint64(band + 1))
    for at in range(values.shape[1]):
        key = mix(key * MULTIPLIER + values[:, at])
    return key.view("int64")


EDGE = fields("a binary, b binary")


def linked(sets: list[np.ndarray], percent: int, blocks: np.ndarray | None = None) -> np.ndarray:
    """For each set the number of the first set of its component under the link rule.

    Only shingles that two sets share matter for intersections. They are counted by multiplying a sets x
    shingles matrix of ones with itself, a run of shingles at a time. With ``blocks`` only pairs of sets of
    different blocks are compared.
    """
    count = len(sets)
    parent = list(range(count))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(s) for s in sets], "int64")
    if count == 2:
        shared = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))], [0, 0]])
    else:
        owner = np.repeat(np.arange(count), sizes)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        times = np.diff(np.append(starts, len(flat)))
        column = np.repeat(np.cumsum(times > 1) - 1, times)
        several = np.repeat(times > 1, times)
        owner, column = owner[several], column[several]
        shared = np.zeros((count, count), "float32")
        step = max(1, (8 << 20) // (4 * count))
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            low, high = np.searchsorted(column, [first, first + step])
            ones = np.zeros((count, step), "float32")
            ones[owner[low:high], column[low:high] - first] = 1
            shared += ones @ ones.T
    union = sizes[:, None] + sizes[None, :] - shared
    pairs = np.triu(100 * shared >= percent * union, 1)
    if blocks is not None:
        pairs &= blocks[:, None] != blocks[None, :]
    for a, b in np.argwhere(pairs).tolist():
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return np.array([find(x) for x in range(count)])


def comparer(width: int, percent: int):
    """Edges of a spanning forest for each run of rows with the same group, as they come sorted."""
    target = arrow_schema(EDGE)

    def edges(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        seen = {rep: (block, data) for rep, block, data in rows}
        if len(seen) < 2:
            return []
        reps = sorted(seen)
        sets = shingle_sets([space_words(seen[r][1] or b"") for r in reps], width)
        held = np.array([seen[r][0] for r in reps])
        across = held if len(np.unique(held)) > 1 else None
        roots = linked(sets, percent, across)
        return [(reps[root], rep) for root, rep in zip(roots.tolist(), reps) if reps[root] != rep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, found = None, [], []
        for batch in slices(batches, "text"):
            for key, rep, block, data in zip(batch.column("grp").to_pylist(), batch.column("digest").to_pylist(), batch.column("block").to_pylist(), utf8(batch.column("text"))):
                if key != group:
                    found += edges(rows)
                    group, rows = key, []
                rows.append((rep, block, data))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], schema=target)
                found = []
        found += edges(rows)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], schema=target)

    return lean(run)


def links(classes: DataFrame, docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges (a, b) that connect the same classes as all confirmed links do."""
    banded = classes.select("digest", "rep", "text_key", "n_shingles", F.explode("bands").alias("band"))
    member = F.xxhash64("digest")
    buckets = (
        banded.groupBy("band")
        .agg(
            F.count("*").alias("n"), F.bit_xor(member).alias("x"), F.sum(F.shiftrightunsigned(member, 24)).alias("s"),
            F.sum("n_shingles").alias("shingles"),
        )
        .where("n > 1")
    )
    once = buckets.groupBy("n", "x", "s").agg(F.min("band").alias("band"), F.max("shingles").alias("shingles"))
    cut = F.ceil(F.greatest(F.col("n") / block_rows, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    members = (
        banded.drop("n_shingles").join(once.select("band", cut.alias("blocks")), "band")
        .withColumn("block", F.pmod(F.xxhash64("digest", F.lit(7)), F.col("blocks")).cast("int"))
        .select("digest", "rep", "text_key", "band", "block", "blocks")
    )
    members = materialize(members, "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_key(F.col("text")).alias("text_key"), "text").where("rep IS NOT NULL")
    wanted = members.select("digest", "rep", "text_key").distinct()
    # repeated rows meet on the same keys and become one again before their text goes to the buckets
    texts = texts.hint("merge").join(wanted, ["rep", "text_key"]).dropDuplicates(["rep", "text_key"])
    texts = materialize(texts.select("digest", "text"), "texts")
    # with one block a bucket is one group; else each block meets itself and every other one
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = members.select("digest", "band", "block", other.alias("other"))
    key = F.xxhash64("band", F.least("block", "other"), F.greatest("block", "other"))
    grouped = paired.select(key.alias("grp"), "digest", "block").join(texts, "digest")
    return grouped.repartition("grp").sortWithinPartitions("grp").select("grp", "digest", "block", "text").mapInArrow(comparer(width, percent), EDGE)


def contract(edges: DataFrame) -> DataFrame:
    """Union-find inside each partition: (a, b) with a the smallest node of b's local component."""
    schema = edges.select("a", "b").schema
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            root = x
            while parent.setdefault(root, root) != root:
                root = parent[root]
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                a, b = find(a), find(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        pairs = [(find(x), x) for x in list(parent) if find(x) != x]
        for first in range(0, len(pairs), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*pairs[first : first + 50_000]), target)], schema=target)

    return edges.select("a", "b").mapInArrow(lean(run), schema)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of an edge: the smallest node that it reaches.

    Labels start as the node itself. Each round a node takes the smallest label among its neighbours and then
    the label of that label; both halve the way to the smallest node, so rounds grow with the logarithm of
    a component's width. The rounds end when no label changes.
    """
    edges = materialize(contract(edges).distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the first round: the smallest neighbour
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = materialize(lower, "lower")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = lower.join(jump, "label").select("node", "old", F.least("label", "further").alias("label"))
        after = materialize(after, "labels")
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels.select("node", F.col("label").alias("component"))


def near_duplicates(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key, first: one row per input row.

    ``component_id`` is the smallest doc_id reachable over links. Null or empty texts, and rows with a null
    id, are linked with nothing: an empty set is its own component, a null id has a null component and is
    kept. Rows that share a doc_id but not their text are judged each by its own set. ``first`` marks the rows whose
    (doc_id, text_key) is the smallest of their component, so that one text of each component can be picked
    whatever its id. An empty table gives an empty result. Columns other than doc_id and text are not read.
    """
    sketch = materialize(sketches(docs, width, bands, rows), "sketches")
    usable = sketch.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "text_key", "n_shingles", "bands")).alias("least")
    classes = usable.groupBy("digest").agg(least).select("digest", F.col("least.doc_id").alias("rep"), "least.text_key", "least.n_shingles", "least.bands")
    classes = materialize(classes, "classes")
    joined = components(links(classes, docs, width, percent, block_rows))
    placed = classes.select("digest", "rep", "text_key").join(joined.withColumnRenamed("node", "digest"), "digest", "left")
    placed = placed.withColumn("component", F.coalesce("component", "digest"))
    heads = placed.groupBy("component").agg(F.min(F.struct("rep", "text_key")).alias("head"))
    resolved = placed.join(heads, "component").select("digest", "head")
    found = sketch.join(resolved, "digest", "left")
    named = F.col("doc_id").isNotNull() & F.col("head").isNotNull()
    component = F.when(named, F.col("head.rep")).otherwise(F.col("doc_id"))
    first = ~named | ((F.col("doc_id") == F.col("head.rep")) & (F.col("text_key") == F.col("head.text_key")))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        "text_key", first.alias("first"),
    )
