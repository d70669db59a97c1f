"""Many linear fits in lockstep: every pass over the rows serves all fits that still run.

A fit is a generator that yields what it wants to know (a ``Request``) and receives a vector. ``solve`` collects the
requests of all fits, answers them in one pass and goes on until every fit has returned. A pass is row-local; each
partition gives one vector per request, and these are added up in a fixed order, so a sum does not depend on which
task came first. The driver holds a few vectors of the capped vocabulary for each fit and never a row.

A row has one sparse vector of term weights for all fits. A ``View`` says how a fit sees it: with its own inverse
document frequencies and norms, and without the rows of one fold.

The rows are packed once into blocks of flat arrays, which are cached as bytes: a pass hands blocks to Python as they
are and converts no vector anew. Texts are dealt out as texts and counted where their block is kept, so vectors are
neither exchanged nor written; their block holds an index and a count (a byte, as a rule) for each entry, and one norm
for each row, block of terms and view. A pass gathers the weights of all its requests at once.
"""

from __future__ import annotations

import pickle
from collections.abc import Generator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.functions import grams, sparse
from corpuslens.functions.memory import trim
from corpuslens.operators.features import joined

#: Numbers of a partial vector that travel in one row.
CHUNK = 1 << 16
#: Partial vectors of more bytes are added up by tasks before they reach the driver.
DRIVER_BYTES = 256 << 20
#: Entries of vectors in a block, about (a row stays whole).
BLOCK_ENTRIES = 1 << 19
#: Texts that are counted at once to make blocks of them, in bytes.
TEXT_BYTES = 1 << 20
#: Entries whose temporary arrays stay in a processor's cache.
PIECE = 1 << 15
#: Columns from which slots of so many entries on average are gone through one by one, all columns at once.
WIDE, LONG = 4, 64
SHARD_ROWS = 50_000
#: Rows for which a partition of its own pays; of fits that need no whole shards, rows of a partition and partitions
#: up to which these count.
PART_ROWS, SPREAD_ROWS, SPREAD_PARTS = 50, 2_000, 96


@dataclass(frozen=True)
class View:
    """``idf`` scales the terms of the blocks that end at ``ends``, each block to unit length; None leaves values as they are."""

    excluded: int | None = None
    idf: np.ndarray | None = None
    ends: tuple[int, ...] = ()

    def inside(self, fold: np.ndarray) -> np.ndarray:
        return np.ones(len(fold), bool) if self.excluded is None else fold != self.excluded

    def scaled(self, weights: np.ndarray) -> np.ndarray:
        return weights if self.idf is None else weights * self.idf


@dataclass(frozen=True)
class Request:
    """What a fit asks of its view: ``kind`` names a function of ``KINDS``; weights are those of the labels 0 and 1."""

    kind: str
    point: np.ndarray
    direction: np.ndarray | None = None
    weights: tuple[float, float] = (1.0, 1.0)
    c: float = 1.0


Fit = Generator[Request, np.ndarray, object]


# ---- what a pass computes -----------------------------------------------------------------------


class Buffers:
    """Arrays that the blocks of a task share: asking the system for megabytes anew costs more than filling them."""

    def __init__(self):
        self.index, self.value, self.entries = np.empty(0, np.int64), np.empty(0), np.empty(0)

    def grow(self, size: int) -> Buffers:
        if size > len(self.index):
            self.index, self.value, self.entries = np.empty(size, np.int64), np.empty(size), np.empty(size)
        return self


class Block:
    """Rows as flat arrays. A slot is the part of a row that has one norm: a row, or a row's terms of one space.

    It holds until the next block uses the same buffers.
    """

    def __init__(self, packed: bytes, buffers: Buffers | None = None):
        lengths, index, value, self.label, self.fold, self.shard, table, slots, self.inverse, self.ids = pickle.loads(packed)
        size = len(index)
        held = (buffers or Buffers()).grow(size)
        self.index, self.value, self.entries = held.index[:size], value, held.entries[:size]
        self.index[:] = index
        if table is not None:
            self.value = held.value[:size]
            for first in range(0, size, PIECE):
                np.take(table, value[first : first + PIECE], out=self.value[first : first + PIECE], mode="clip")
        self.rows, self.lengths = len(lengths), lengths
        self.slots = lengths if slots is None else slots
        ends = np.cumsum(self.slots)
        self.starts = ends - self.slots
        cuts = [0, *(np.flatnonzero(np.diff(ends // PIECE)) + 1).tolist(), len(ends)]
        self.pieces = [(a, b, int(self.starts[a]), int(ends[b - 1])) for a, b in zip(cuts, cuts[1:]) if a < b]
        self.long = len(index) >= LONG * len(self.slots)

    def products(self, wide: np.ndarray) -> np.ndarray:
        """Dot product of every slot with every column."""
        count = wide.shape[1]
        found = np.zeros((len(self.slots), count))
        if count >= WIDE and self.long:
            held = np.empty((int(self.slots.max(initial=0)), count))
            for slot, (start, size) in enumerate(zip(self.starts.tolist(), self.slots.tolist())):
                if size:
                    some = held[:size]
                    np.take(wide, self.index[start : start + size], axis=0, out=some, mode="clip")
                    np.dot(self.value[start : start + size], some, out=found[slot])
            return found
        full = np.flatnonzero(self.slots)
        if len(full):
            held = self.entries
            for number in range(count):
                np.take(np.ascontiguousarray(wide[:, number]), self.index, out=held, mode="clip")
                np.multiply(held, self.value, out=held)
                found[full, number] = np.add.reduceat(held, self.starts[full])
        return found

    def scatter(self, factors: np.ndarray, total: np.ndarray) -> None:
        """Add to ``total`` (columns, features) the slots times their factors (columns, slots)."""
        for own, factor in zip(total, factors):
            for first, last, start, end in self.pieces:
                np.multiply(np.repeat(factor[first:last], self.slots[first:last]), self.value[start:end], out=self.entries[start:end])
            own += np.bincount(self.index, self.entries, len(own))

    def scale(self, number: int) -> np.ndarray | None:
        """Inverse norms of the slots in one view."""
        return None if self.inverse is None else self.inverse[number]

    def by_row(self, found: np.ndarray, scale: np.ndarray | None) -> np.ndarray:
        """Products of the slots, one column, as those of the rows."""
        if scale is not None:
            found = found * scale
        return found.reshape(self.rows, -1).sum(axis=1) if self.rows else found

    def by_slot(self, factor: np.ndarray, scale: np.ndarray | None) -> np.ndarray:
        factor = np.repeat(factor, len(self.slots) // max(self.rows, 1))
        return factor if scale is None else factor * scale


@dataclass(frozen=True)
class Rows:
    """A run of rows as one view sees them."""

    lengths: np.ndarray
    index: np.ndarray
    value: np.ndarray
    label: np.ndarray
    inside: np.ndarray
    shard: np.ndarray

    @classmethod
    def of(cls, block: Block, view: View, number: int) -> Rows:
        value, scale = block.value, block.scale(number)
        if view.idf is not None:
            value = value * view.idf[block.index]
        if scale is not None:
            value = value * np.repeat(scale, block.slots)
        return cls(block.lengths, block.index, value, block.label, view.inside(block.fold), block.shard)


# Each kind gives factors of the rows (their sum times the rows is asked for) and what is to be added up besides, from
# the signs of the labels, the weights of the rows and their margins at the point and in the direction.


def logistic_gradient(y, s, point, direction):
    """Gradient, then the loss."""
    z = y * point
    return [-s * y * 0.5 * (1.0 + np.tanh(-0.5 * z))], [(s * np.logaddexp(0.0, -z)).sum()]


def logistic_curvature(y, s, point, direction):
    """Second derivative times the direction."""
    chance = 0.5 * (1.0 + np.tanh(0.5 * y * point))
    return [s * chance * (1.0 - chance) * direction], []


def hinge_gradient(y, s, point, direction):
    """Of the squared hinge: gradient, then the loss."""
    short = np.maximum(0.0, 1.0 - y * point)
    return [-2.0 * s * y * short], [(s * short * short).sum()]


def hinge_curvature(y, s, point, direction):
    return [2.0 * s * (y * point < 1.0) * direction], []


KINDS = {
    "logistic": logistic_gradient,
    "logistic curvature": logistic_curvature,
    "squared hinge": hinge_gradient,
    "squared hinge curvature": hinge_curvature,
}


class Additive:
    """Sums of some requests over the rows of a partition: the weights of all are gathered together, row by row."""

    def __init__(self, views: list[View], asked: list[tuple[int, Request]]):
        self.views, self.asked, self.met = views, asked, False
        columns, self.places, self.sums, width = [], [], [], 0
        for number, r in asked:
            vectors = [] if r.kind == "class sums" else [r.point] if r.direction is None else [r.point, r.direction]
            own = 2 if r.kind == "class sums" else 1
            self.places.append((len(columns), len(vectors), width, own))
            self.sums.append(np.zeros(own + (r.direction is None and own == 1)))
            columns += [views[number].scaled(v[:-1]) for v in vectors]
            width += own
        size = len(asked[0][1].point) - 1
        self.wide = np.ascontiguousarray(np.array(columns).T) if columns else np.zeros((size, 0))
        self.total = np.zeros((width, size))

    def add(self, block: Block) -> None:
        self.met = True
        found = block.products(self.wide)
        factors = np.empty((len(self.total), len(block.slots)))
        for (number, r), (first, vectors, column, own), sums in zip(self.asked, self.places, self.sums):
            scale, inside = block.scale(number), self.views[number].inside(block.fold)
            if r.kind == "class sums":
                rows, more = [(inside & (block.label == k)).astype(float) for k in (0, 1)], []
            else:
                # the last weight is the intercept's, on a feature of 1
                margins = [block.by_row(found[:, first + i], scale) + v[-1] for i, v in enumerate((r.point, r.direction)[:vectors])]
                y = np.where(block.label == 1, 1.0, -1.0)
                s = np.where(block.label == 1, r.weights[1], r.weights[0]) * inside
                rows, more = KINDS[r.kind](y, s, margins[0], margins[-1])
            sums += [*(f.sum() for f in rows), *more]
            for i, f in enumerate(rows):
                factors[column + i] = block.by_slot(f, scale)
        block.scatter(factors, self.total)

    def results(self) -> list[np.ndarray | None]:
        """Of each request: the summed rows with the feature of 1 behind, for each of its factors, then what else it sums."""
        if not self.met:
            return [None] * len(self.asked)
        out = []
        for (number, _), (_, _, column, own), sums in zip(self.asked, self.places, self.sums):
            parts = [np.append(self.views[number].scaled(self.total[column + i]), sums[i]) for i in range(own)]
            out.append(np.concatenate([*parts, sums[own:]]))
        return out


class Epoch:
    """One passive-aggressive pass over each shard from the shared weights.

    Added up over the shards of a partition: change of the weights times rows, change of their mean times rows,
    loss, rows.
    """

    def __init__(self, request: Request):
        self.request, self.shard, self.total = request, None, None

    def close(self) -> None:
        if self.shard is not None and self.rows:
            start, rows = self.request.point, self.rows
            mean = self.w - self.mean / rows
            found = np.concatenate([(self.w - start) * rows, (mean - start) * rows, [self.loss, rows]])
            self.total = found if self.total is None else self.total + found

    def add(self, rows: Rows) -> None:
        r = self.request
        ends = np.cumsum(rows.lengths)
        squares = sparse.row_sums(rows.lengths, rows.value * rows.value) + 1.0
        for i in np.flatnonzero(rows.inside):
            if rows.shard[i] != self.shard:
                self.close()
                self.shard, self.rows, self.loss = rows.shard[i], 0, 0.0
                self.w, self.mean = r.point.copy(), np.zeros_like(r.point)
            ix, x = rows.index[ends[i] - rows.lengths[i] : ends[i]], rows.value[ends[i] - rows.lengths[i] : ends[i]]
            label = 1 if rows.label[i] == 1 else 0
            y = 1.0 if label == 1 else -1.0
            loss = max(0.0, 1.0 - y * (float(self.w[ix] @ x) + self.w[-1]))
            self.rows += 1
            if loss > 0.0:
                step = min(r.c * r.weights[label], loss / squares[i]) * y
                self.w[ix] += step * x
                self.w[-1] += step
                # the mean over rows, kept sparse: an update counts from this row on
                self.mean[ix] += step * x * (self.rows - 1)
                self.mean[-1] += step * (self.rows - 1)
            self.loss += loss

    def result(self) -> np.ndarray | None:
        self.close()
        return self.total


# ---- passes -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dealt:
    """Cached blocks of rows in shards, and the number of partitions at most."""

    blocks: RDD
    parts: int

    def __enter__(self) -> Dealt:
        return self

    def __exit__(self, *_) -> None:
        self.blocks.unpersist()


def blocks_of(lengths, index, value, label, fold, shard, table=None, slots=None, inverse=None, ids=None):
    """Pickled blocks of rows, each of about ``BLOCK_ENTRIES``; a row stays whole."""
    ends = np.cumsum(lengths)
    cuts = [0, *(np.flatnonzero(np.diff(ends // BLOCK_ENTRIES)) + 1).tolist(), len(lengths)]
    spaces = 1 if slots is None else len(slots) // max(len(lengths), 1)
    for first, last in zip(cuts, cuts[1:]):
        if first < last:
            rows, entries, own = slice(first, last), slice(ends[first] - lengths[first], ends[last - 1]), slice(first * spaces, last * spaces)
            block = (
                lengths[rows], index[entries], value[entries], label[rows], fold[rows], shard[rows], table,
                None if slots is None else slots[own], None if inverse is None else inverse[:, own], None if ids is None else ids.slice(first, last - first),
            )
            yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(block, protocol=5)], pa.binary())})


def _marks(batch):
    # a null label is neither class
    return [np.asarray(batch.column(c).fill_null(-1)).astype(np.int32) for c in ("label", "fold", "shard")]


def packed(batches):
    """Rows as pickled blocks of flat arrays: lengths, index, value, label, fold, shard."""
    for batch in batches:
        yield from blocks_of(*sparse.unpack(batch.column("features")), *_marks(batch))


def packed_texts(counter, sublinear: tuple[bool, ...], starts: tuple[int, ...], views: Broadcast):
    """The same from texts: occurrences of the terms of all spaces, whose weights are in a table, and norms in all views."""

    def run(batches):
        for batch in batches:
            texts, marks = batch.column("__source"), _marks(batch)
            ids = pa.RecordBatch.from_arrays([batch.column("row_id"), batch.column("label")], names=["row_id", "label"])
            for start, rows in grams.runs(grams.sizes_of(texts), TEXT_BYTES):
                counts = counter.counts(texts.slice(start, rows))
                most = int(max((tf.max(initial=0.0) for _, _, tf in counts), default=0.0)) + 1
                table = np.append(1.0 + np.log(np.maximum(np.arange(most), 1)), np.arange(most, dtype=float))
                codes = [tf if logs else tf + most for (_, _, tf), logs in zip(counts, sublinear)]
                lengths, index, _, code = joined(counts, starts, rows, codes)
                code, slots = code.astype(np.min_scalar_type(2 * most)), np.column_stack([own for own, _, _ in counts]).ravel()
                inverse = np.ones((len(views.value), len(slots)))
                value, full = table[code], np.flatnonzero(slots)
                for number, view in enumerate(views.value):
                    if view.idf is not None and len(full):
                        norm = np.sqrt(np.add.reduceat((value * view.idf[index]) ** 2, (np.cumsum(slots) - slots)[full]))
                        norm[norm == 0.0] = 1.0
                        inverse[number, full] = 1.0 / norm
                yield from blocks_of(
                    lengths, index.astype(np.int32), code, *(m[start : start + rows] for m in marks), table, slots.astype(np.int32),
                    inverse, ids.slice(start, rows),
                )
        trim()

    return run


def even_keys(spark, parts: int) -> list[int]:
    """A number for each of ``parts`` partitions that Spark's hash puts there: shards by their own number would share some."""
    placed = spark.range(0, 64 * parts, 1, 1).select(F.col("id").cast("int").alias("key"))
    placed = placed.groupBy(F.pmod(F.hash("key"), F.lit(parts)).alias("part")).agg(F.min("key").alias("key"))
    found = {r["part"]: r["key"] for r in placed.collect()}
    return [found.get(part, part) for part in range(parts)]


def dealt(df: DataFrame, rows: int, shards: int = 8, whole_shards: bool = True, pack=packed) -> Dealt:
    """The rows in blocks, with every shard whole, in one partition and in the order of a hash of ``row_id``.

    The numbers of shards and partitions come from that of the rows, not from the cluster, so results do not depend on it.
    Sums do not need whole shards; without them there are more partitions. ``pack`` makes blocks of batches; rows have
    ``features`` for it, or lower-cased texts as ``__source``.
    """
    count = max(shards, -(-rows // SHARD_ROWS))
    if not whole_shards:
        count = max(count, min(SPREAD_PARTS, -(-rows // SPREAD_ROWS)))
    parts = max(1, min(count, -(-rows // PART_ROWS)))
    hashed = F.xxhash64("row_id")
    fold = F.col("fold") if "fold" in df.columns else F.lit(-1)
    source = "features" if "features" in df.columns else "__source"
    shard = F.pmod(hashed, F.lit(count)).cast("int")
    keys = F.array(*map(F.lit, even_keys(df.sparkSession, parts)))
    shared = (
        df.select(shard.alias("shard"), keys[shard % parts].alias("key"), hashed.alias("place"), "row_id", fold.alias("fold"), "label", source)
        .repartition(parts, "key")
        .sortWithinPartitions("shard", "place", "row_id")
        .select("shard", "fold", "label", source, *(["row_id"] if source == "__source" else []))
        .mapInArrow(pack, "block binary")
    )
    return Dealt(shared.rdd.map(lambda row: bytes(row[0])).persist(StorageLevel.MEMORY_AND_DISK), parts)


def dealt_texts(
    df: DataFrame, rows: int, counter, sublinear: tuple[bool, ...], views: list[View], shards: int = 8, whole_shards: bool = True
) -> Dealt:
    """Rows (row_id, label, clean and perhaps fold) in blocks with what ``counter`` finds in them, its spaces as in ``views``."""
    sent = df.sparkSession.sparkContext.broadcast(views)
    texts = df.select("row_id", "label", *(["fold"] if "fold" in df.columns else []), F.lower("clean").alias("__source"))
    return dealt(texts, rows, shards, whole_shards, packed_texts(counter, sublinear, (0, *views[0].ends[:-1]), sent))


def answered(data: Dealt, sent: Broadcast, asked: list[tuple[int, Request]]) -> list[np.ndarray]:
    """One pass: the vector for every (view, request); ``sent`` holds the views, which stay with the workers for all passes.

    A vector is all zeros, of length 0, where no row was met.
    """
    loaded = data.blocks.context.broadcast(asked)

    def run(part, blocks):
        views, asked = sent.value, loaded.value
        epochs = {n: Epoch(r) for n, (_, r) in enumerate(asked) if r.kind == "epoch"}
        others = [n for n in range(len(asked)) if n not in epochs]
        sums = Additive(views, [asked[n] for n in others]) if others else None
        buffers = Buffers()
        for block in (Block(b, buffers) for b in blocks):
            for number, epoch in epochs.items():
                view = asked[number][0]
                epoch.add(Rows.of(block, views[view], view))
            if sums is not None:
                sums.add(block)
        found = {n: e.result() for n, e in epochs.items()} | dict(zip(others, sums.results() if others else []))
        for number, vector in found.items():
            if vector is not None:
                for chunk, first in enumerate(range(0, len(vector), CHUNK)):
                    yield (number, chunk), (part, vector[first : first + CHUNK].tobytes())

    def added(parts):
        total = None
        for _, data_ in sorted(parts):
            vector = np.frombuffer(data_)
            total = vector.copy() if total is None else total + vector
        return total.tobytes()

    partial = data.blocks.mapPartitionsWithIndex(run)
    width = sum(len(r.point) * (2 if r.kind in ("epoch", "class sums") else 1) * 8 for _, r in asked)
    if width * data.parts > DRIVER_BYTES:
        partial = partial.groupByKey(data.parts).mapValues(lambda parts: (0, added(parts)))
    try:
        found = partial.collect()
    finally:
        loaded.destroy()
    by_key: dict[tuple[int, int], list] = {}
    for key, value in found:
        by_key.setdefault(key, []).append(value)
    out: list[list[np.ndarray]] = [[] for _ in asked]
    for request, chunk in sorted(by_key):
        out[request].append(np.frombuffer(added(by_key[request, chunk])))
    return [np.concatenate(parts) if parts else np.zeros(0) for parts in out]


def solve(data: Dealt, views: list[View], fits: list[tuple[int, Fit]]) -> list[object]:
    """Run all (view, fit) to their end and return what they return."""
    results: list[object] = [None] * len(fits)
    waiting: dict[int, Request] = {}

    def advance(number: int, answer: np.ndarray | None) -> None:
        try:
            waiting[number] = fits[number][1].send(answer)
        except StopIteration as end:
            results[number] = end.value

    for number in range(len(fits)):
        advance(number, None)
    if not waiting:
        return results
    sent = data.blocks.context.broadcast(views)
    try:
        while waiting:
            numbers = sorted(waiting)
            answers = answered(data, sent, [(fits[n][0], waiting.pop(n)) for n in numbers])
            for number, answer in zip(numbers, answers):
                advance(number, answer)
    finally:
        sent.destroy()
    return results


# ---- fits ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Solution:
    weights: np.ndarray
    iterations: int
    converged: bool
    gradient: float = 0.0


def trust_region_newton(
    loss: str, size: int, weights: tuple[float, float], c: float, *, penalise_intercept: bool = False,
    limit: int = 1000, tolerance: float = 1e-5,
) -> Fit:
    """Minimise ``1/2 |w|^2 + C sum(s_i loss_i)`` for the logistic loss or the squared hinge.

    Each Newton step is found by conjugate gradients inside a trust region; every product with the second derivative is
    a pass. Ends when the gradient has shrunk to ``tolerance`` of the first one.
    """
    penalty = np.ones(size + 1)
    penalty[-1] = 1.0 if penalise_intercept else 0.0

    def value(w: np.ndarray, answer: np.ndarray) -> tuple[float, np.ndarray]:
        return 0.5 * float(penalty * w @ w) + c * float(answer[-1]), penalty * w + c * answer[:-1]

    w = np.zeros(size + 1)
    answer = yield Request(loss, w, weights=weights)
    if not len(answer):
        return Solution(w, 0, True)
    f, g = value(w, answer)
    start = radius = float(np.linalg.norm(g))
    done, stuck = 0, False
    while (steep := float(np.linalg.norm(g))) > tolerance * start and done < limit and not stuck:
        enough = min(0.1, np.sqrt(steep / start)) * steep
        s, r = np.zeros_like(w), -g
        d, rr = r.copy(), float(r @ r)
        edge = False
        for _ in range(size + 1):
            if np.sqrt(rr) <= enough:
                break
            curved = penalty * d + c * (yield Request(f"{loss} curvature", w, d, weights))
            bend = float(d @ curved)
            step = rr / bend if bend > 0.0 else np.inf
            if bend <= 0.0 or np.linalg.norm(s + step * d) >= radius:
                # to the edge of the region
                sd, dd, ss = float(s @ d), float(d @ d), float(s @ s)
                step = (-sd + np.sqrt(sd * sd + dd * (radius * radius - ss))) / dd
                edge = True
            s = s + step * d
            r = r - step * curved
            if edge:
                break
            before, rr = rr, float(r @ r)
            d = r + rr / before * d
        answer = yield Request(loss, w + s, weights=weights)
        after, slope = value(w + s, answer)
        promised = 0.5 * float(s @ r - g @ s)
        kept = f - after
        # what is promised is lost in the sum's rounding: no better point can be told
        stuck = promised <= 1e-14 * abs(f)
        length = float(np.linalg.norm(s))
        if kept < 0.25 * promised:
            radius = 0.25 * min(radius, length)
        elif kept > 0.75 * promised and edge:
            radius *= 2.0
        if kept > 1e-4 * promised:
            w, f, g = w + s, after, slope
        done += 1
    steep = float(np.linalg.norm(g))
    return Solution(w, done, stuck or steep <= tolerance * start, steep)


def passive_aggressive(
    size: int, weights: tuple[float, float], c: float, *, limit: int = 1500, tolerance: float = 1e-3, patience: int = 5
) -> Fit:
    """Averaged passive-aggressive learning; shards are mixed in proportion to their rows after each epoch.

    Ends after ``patience`` epochs without a loss smaller by ``tolerance``.
    """
    current, averaged = np.zeros(size + 1), np.zeros(size + 1)
    best, waited, done = np.inf, 0, 0
    while done < limit and waited < patience:
        answer = yield Request("epoch", current, weights=weights, c=c)
        if not len(answer):
            return Solution(averaged, done, True)
        rows = answer[-1]
        delta, mean, loss = answer[: size + 1] / rows, answer[size + 1 : -2] / rows, answer[-2] / rows
        averaged = (averaged * done + current + mean) / (done + 1)
        current = current + delta
        done += 1
        waited = 0 if loss < best - tolerance else waited + 1
        best = min(best, loss)
    return Solution(averaged, done, waited >= patience)


def summed_by_class(size: int) -> Fit:
    """Sums of the vectors of each label."""
    answer = yield Request("class sums", np.zeros(size + 1))
    answer = answer if len(answer) else np.zeros(2 * size + 2)
    return {0: answer[:size], 1: answer[size + 1 : -1]}
