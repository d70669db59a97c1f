"""Repair of conversation structure: cheapest edits, the least audit among them, by prefix-doubling path ranking.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Its rows stand in the order of turn (nulls
first), role and text. Edits are Keep, Rerole (to user or assistant), Delete and Insert (an empty user or assistant
text anywhere); the audit is the string of their initials.

One node stands for "``i`` rows are done, the kept roles have led to state ``s``". A backward pass gives each node the
cost to the end (``cost_to_go``). Arcs that keep to it are optimal. From a node each initial leads to one
node only, so the nodes' first letters rank them for audits of length 1; ranks for 2, 4, 8, … letters are those of
the pair (own rank, rank of the node that many letters on), and pointers double with them (``ranked``). Every node
then takes the arc with the least initial and, behind it, the least rank, and doubled pointers read whole paths at once.

Conversations of at most ``SHORT_ROWS`` rows and ``SHORT_BYTES`` of text go to tasks whole, many at a time (``whole``).
Longer ones are cut into blocks by range, wherever that falls (``in_blocks``): each block has a 4 x 4 matrix of
least costs, the matrices of a conversation give the cost behind each block, that gives the way of each block
for each of four entry states, and those lead from block to block. Equal rows of one turn travel as one with a number.

Cases: a null role or text counts as one space; a null id is a conversation of its own; null turns come first; repeated
rows are duplicates; rows are taken by name, so other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import arrow_schema, fields
from corpuslens.sources.tables import materialize

KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 3, 4, 3, 3
SHORT_ROWS, SHORT_BYTES = 4096, 16 << 20
BLOCK_ROWS = 20_000
CHUNK_ROWS, CHUNK_BYTES = 20_000, 8 << 20

GOOD, BLANK, DUPLICATE, TRUNCATED = range(4)
DELETE, INSERT, KEEP, REROLE = range(4)
#: In ASCII order, which is the order of the numbers above.
LETTERS = np.array(list("DIKR"), dtype=object)

#: States: nothing yet, after system, after user, after assistant. What a new role must be, and where a kept one leads.
FORCED = np.array([2, 2, 3, 2])
DEAD = 4
INITIALS = {"s": 1, "u": 2, "a": 3}
KEPT = np.array([[DEAD] * 4, [1, DEAD, DEAD, DEAD], [2, 2, DEAD, 2], [DEAD, DEAD, 3, DEAD]])
ROLE_OF = np.array([None, None, "user", "assistant"], dtype=object)
#: Behind the last row only inserts are left.
END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
INFINITE = 1 << 50

STEP = "conv string, conv_id long, block long, step long, edit string, times long, role string, text string, turn long, flaw int, was string"


# ---- rows ---------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after a fixed damage by the CRC-32 of ``conv_id:turn`` modulo 20.

    0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats it, 4 makes it the user's. Nulls count as one space.
    """

    def name(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.regexp_replace(name("text"), "[.!?]", "")).otherwise(name("text"))
    return rows.where(code != 0).select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(name("role")).alias("role"), text.alias("text"),
        F.when(code == 3, 2).otherwise(1).alias("copies"),
    )


def described(rows: DataFrame) -> DataFrame:
    """Rows with a conversation key, a digest of role and text, and the flaw that the row alone shows."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    flaw = (
        F.when(~text.rlike(r"[^\x20\x09-\x0D]"), BLANK)
        .when(~text.rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED)
        .otherwise(GOOD)
    )
    copies = F.col("copies") if "copies" in rows.columns else F.lit(1)
    conv_id = F.col("conv_id").cast("long")
    key = F.coalesce(conv_id.cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return rows.select(
        key.alias("conv"), conv_id.alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        copies.cast("long").alias("copies"), digest.alias("digest"), flaw.alias("flaw"),
    )


# ---- the ranking --------------------------------------------------------------------------------


class Items:
    """Rows of one or several blocks as numbers; a row of several copies is the first and a run of duplicates."""

    def __init__(self, table: pa.Table, starts: np.ndarray, first: np.ndarray):
        flaw = table.column("flaw").to_numpy().astype("int64")
        copies = table.column("copies").to_numpy()
        flaw = np.where((flaw != BLANK) & ~first, DUPLICATE, flaw)
        alone = (flaw == GOOD) | (flaw == TRUNCATED)
        parts = 1 + (alone & (copies > 1))
        self.row = np.repeat(np.arange(len(flaw)), parts)
        later = np.zeros(len(self.row), bool)
        later[1:] = self.row[1:] == self.row[:-1]
        self.flaw = np.where(later, DUPLICATE, flaw[self.row])
        self.times = np.where(later, copies[self.row] - 1, np.where(alone[self.row], 1, copies[self.row]))
        self.starts = np.concatenate([[0], np.cumsum(parts)])[np.append(starts, len(flaw))]
        initials = [role[:1] for role in table.column("role").to_pylist()]
        self.initials = np.array(initials, dtype=object)
        self.code = np.array([INITIALS.get(i, 0) for i in initials], "int64")[self.row]
        self.stays = (self.flaw == GOOD) | (self.flaw == TRUNCATED)
        self.extra = np.where(self.flaw == TRUNCATED, TRUNCATED_COST, 0)
        self.blocks = np.repeat(np.arange(len(starts)), np.diff(self.starts))

    def __len__(self) -> int:
        return len(self.row)


def stepped(items: Items, chosen, after: np.ndarray) -> np.ndarray:
    """Least cost over the row at hand from each state, given the costs behind it: (items, 4, ends)."""
    dead = np.full((len(after), 1, after.shape[2]), INFINITE)
    wide = np.concatenate([after, dead], axis=1)
    stays, extra = items.stays[chosen, None, None], items.extra[chosen, None, None]
    keep = np.take_along_axis(wide, KEPT[items.code[chosen]][:, :, None], axis=1) + KEEP_COST + extra
    rerole = after[:, FORCED] + REROLE_COST + extra
    delete = after + DELETE_COST * items.times[chosen, None, None]
    return np.minimum(delete, np.where(stays, np.minimum(keep, rerole), INFINITE))


def cost_to_go(items: Items, end: np.ndarray) -> np.ndarray:
    """Costs before every item (items, 4, ends) from those behind each block (blocks, 4, ends).

    Blocks go hand in hand: step t takes the t-th last item of each.
    """
    out = np.empty((len(items), 4, end.shape[2]), "int64")
    lengths = np.diff(items.starts)
    order = np.argsort(-lengths, kind="stable")
    last, sizes = items.starts[1:][order], lengths[order]
    now = end[order].copy()
    for t in range(int(lengths.max(initial=0))):
        active = int(np.searchsorted(-sizes, -t, side="left"))
        at = last[:active] - 1 - t
        over = stepped(items, at, now[:active])
        once, twice = over[:, FORCED] + INSERT_COST, over[:, FORCED[FORCED]] + 2 * INSERT_COST
        now[:active] = np.minimum(np.minimum(over, np.minimum(once, twice)), INFINITE)
        out[at] = now[:active]
    return out


def ranked(items: Items, costs: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Chosen initial of every node, pointers doubled level by level, and steps to the end of the block.

    Nodes are item * 4 + state; behind them come four for each block's end, which point to themselves.
    """
    n, states = len(items), np.arange(4)
    behind = np.empty_like(costs)
    behind[:-1] = costs[1:]
    filled = np.diff(items.starts) > 0
    behind[items.starts[1:][filled] - 1] = end[filled]
    wide = np.concatenate([behind, np.full((n, 1), INFINITE)], axis=1)
    kept = KEPT[items.code]
    finite = costs < INFINITE
    stays, extra = items.stays[:, None], items.extra[:, None]
    optimal = np.stack(
        [
            behind + DELETE_COST * items.times[:, None] == costs,
            costs[:, FORCED] + INSERT_COST == costs,
            stays & (np.take_along_axis(wide, kept, axis=1) + KEEP_COST + extra == costs),
            stays & (behind[:, FORCED] + REROLE_COST + extra == costs),
        ],
        axis=2,
    ) & finite[:, :, None]
    following = np.arange(n) + 1
    following[items.starts[1:][filled] - 1] = n + np.flatnonzero(filled)
    base, here = following[:, None] * 4, np.arange(n)[:, None] * 4
    targets = np.stack(
        [base + states, here + FORCED[None, :], base + np.where(kept == DEAD, 0, kept), base + FORCED[None, :]], axis=2
    ).reshape(4 * n, 4)
    optimal = optimal.reshape(4 * n, 4)
    nodes = 4 * (n + len(items.starts) - 1)
    none = ~optimal.any(axis=1)
    letter = np.where(none, 0, optimal.argmax(axis=1) + 1)
    pointer = np.arange(nodes)
    pointer[: 4 * n] = np.where(none, pointer[: 4 * n], targets[np.arange(4 * n), np.maximum(letter - 1, 0)])
    rank = np.zeros(nodes, "int64")
    rank[: 4 * n] = letter
    steps = (pointer != np.arange(nodes)).astype("int64")
    levels = [pointer]
    while True:
        further = levels[-1][levels[-1]]
        rank = np.unique(rank * (nodes + 1) + rank[levels[-1]], return_inverse=True)[1].astype("int64")
        if (further == levels[-1]).all():
            break
        steps = steps + steps[levels[-1]]
        levels.append(further)
    # the optimal arc with the least initial, and with the least rank behind it
    order = np.where(optimal, np.arange(4)[None, :] * nodes + rank[targets], 4 * nodes)
    return order.argmin(axis=1), levels, steps


def paths(items: Items, entry: np.ndarray, levels: list[np.ndarray], steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on the path of each block from its entry state, one after the other, and the block of each."""
    filled = np.diff(items.starts) > 0
    begin = np.where(filled, items.starts[:-1] * 4, (len(items) + np.arange(len(entry))) * 4) + entry
    lengths = steps[begin]
    owner = np.repeat(np.arange(len(begin)), lengths)
    ahead = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    node = begin[owner]
    for level, pointer in enumerate(levels):
        node = np.where(ahead >> level & 1 == 1, pointer[node], node)
    return node, owner


def exits(items: Items, levels: list[np.ndarray], entry: np.ndarray) -> np.ndarray:
    """State in which each block's path ends."""
    filled = np.diff(items.starts) > 0
    begin = items.starts[:-1] * 4 + entry
    return np.where(filled, levels[-1][np.where(filled, begin, 0)] % 4, entry)


def steps_of(table: pa.Table, items: Items, entry: np.ndarray, end: np.ndarray, last: np.ndarray, block: np.ndarray) -> pa.Table:
    """``STEP`` rows of every block; the last block of a conversation has its inserts behind the last row as well."""
    costs = cost_to_go(items, end[:, :, None])[:, :, 0]
    letters, levels, steps = ranked(items, costs, end)
    node, owner = paths(items, entry, levels, steps)
    final = exits(items, levels, entry)
    tail = np.where(last, END[final] // INSERT_COST, 0)
    letter, state = letters[node], node % 4
    item = node // 4
    # inserts behind the last row, in the order of the blocks
    more = np.repeat(np.arange(len(tail)), tail)
    count = np.arange(len(more)) - np.repeat(np.cumsum(tail) - tail, tail)
    late = np.where(count == 1, FORCED[final[more]], final[more])
    owner, order = np.concatenate([owner, more]), np.argsort(np.concatenate([owner, more]), kind="stable")
    owner = owner[order]
    letter = np.concatenate([letter, np.full(len(more), INSERT)])[order]
    state = np.concatenate([state, late])[order]
    item = np.concatenate([item, np.full(len(more), -1)])[order]
    inserted = letter == INSERT
    head = items.starts[:-1]
    row = np.where(inserted, items.row[np.minimum(head[owner], max(len(items) - 1, 0))], items.row[np.maximum(item, 0)])
    new = ROLE_OF[FORCED[state]]
    taken = table.take(pa.array(row))
    role = np.where(inserted | (letter == REROLE), new, np.array(taken.column("role").to_pylist(), dtype=object))
    at = np.arange(len(owner)) - np.searchsorted(owner, owner)
    hidden = pa.array(inserted)
    none = pa.scalar(None)
    flaw = np.where(inserted, -1, items.flaw[np.maximum(item, 0)])
    columns = {
        "conv": taken.column("conv"), "conv_id": taken.column("conv_id"), "block": pa.array(block[owner]), "step": pa.array(at),
        "edit": pa.array(LETTERS[letter], pa.string()), "times": pa.array(np.where(inserted, 1, items.times[np.maximum(item, 0)])),
        "role": pa.array(role, pa.string()),
        "text": pc.if_else(hidden, pa.scalar("", taken.schema.field("text").type), taken.column("text")),
        "turn": pc.if_else(hidden, none.cast(pa.int64()), taken.column("turn")),
        "flaw": pa.array(flaw), "was": pa.array(np.where(inserted, None, items.initials[row]), pa.string()),
    }
    target = arrow_schema(fields(STEP))
    return pa.table([columns[f.name].cast(f.type) for f in target], schema=target)


def first_places(table: pa.Table, owner: np.ndarray) -> np.ndarray:
    """Whether a row is the first with its role and text in its conversation."""
    code = table.column("digest").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype("int64")
    first = np.zeros(len(code), bool)
    first[np.unique(owner * (code.max(initial=0) + 1) + code, return_index=True)[1]] = True
    return first


# ---- whole conversations ------------------------------------------------------------------------


def whole(rows: DataFrame) -> DataFrame:
    """Steps of conversations that fit into a task; partitions keep theirs together and in order."""
    schema = fields(STEP)

    def solved(table: pa.Table) -> pa.Table:
        keys = table.column("conv").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))
        items = Items(table, starts, first_places(table, owner))
        count = len(starts)
        return steps_of(table, items, np.zeros(count, "int64"), np.tile(END, (count, 1)), np.ones(count, bool), np.zeros(count, "int64"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[pa.Table] = []

        def flush(all_of_it: bool) -> Iterator[pa.RecordBatch]:
            table = pa.concat_tables(pending)
            pending.clear()
            cut = len(table)
            if not all_of_it:
                keys = table.column("conv").to_pylist()
                while cut and keys[cut - 1] == keys[-1]:
                    cut -= 1
                pending.append(table.slice(cut))
            if cut:
                yield from solved(table.slice(0, cut)).to_batches()

        for batch in batches:
            for first in range(0, batch.num_rows, CHUNK_ROWS):
                pending.append(pa.Table.from_batches([batch.slice(first, CHUNK_ROWS)]))
                if sum(map(len, pending)) >= CHUNK_ROWS or sum(t.nbytes for t in pending) >= CHUNK_BYTES:
                    yield from flush(False)
        if pending and sum(map(len, pending)):
            yield from flush(True)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv", "conv_id", "turn", "role", "text", "copies", "digest", "flaw").mapInArrow(run, schema)


# ---- conversations in blocks --------------------------------------------------------------------


def in_blocks(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Steps of conversations of any length; a block is what one range of the rows holds of a conversation."""
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    once = rows.groupBy("conv", "conv_id", "turn", "role", "text", "digest", "flaw").agg(F.sum("copies").alias("copies"))
    once = materialize(once, "dialogue-rows")
    starts = once.groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(F.min(turn).alias("t"))
    # a text repeated over a third of all turns is one row of the right side and a skewed key of the left one
    marked = once.hint("merge").join(starts, (F.col("conv") == F.col("c")) & (F.col("digest") == F.col("d")))
    marked = marked.withColumn("first", F.col("turn").eqNullSafe(F.col("t.turn"))).drop("c", "d", "t")
    size = once.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    parts = max(1, -(-size["rows"] // block_rows), -(-size["bytes"] // SHORT_BYTES))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    cut = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # the number holds the partition above and the place below, so it names the block and orders the rows
    cut = cut.withColumn("place", F.monotonically_increasing_id()).withColumn("block", F.shiftright("place", 33))
    cut = materialize(cut, "dialogue-blocks")
    narrow = cut.drop("text", "digest")

    def items_of(table: pa.Table) -> tuple[pa.Table, Items]:
        table = table.sort_by("place")
        return table, Items(table, np.zeros(1, "int64"), table.column("first").to_numpy(zero_copy_only=False))

    def matrix(table: pa.Table) -> pa.Table:
        _, items = items_of(table)
        unit = np.where(np.eye(4, dtype=bool), 0, INFINITE)[None]
        return pa.table({"conv": table.column("conv")[:1], "block": table.column("block")[:1], "costs": pa.array([cost_to_go(items, unit)[0].ravel()])})

    def backward(table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "descending")])
        now, out = END, []
        for costs in table.column("costs").to_pylist():
            out.append(now)
            now = np.minimum((np.array(costs).reshape(4, 4) + now[None, :]).min(axis=1), INFINITE)
        return pa.table({"conv": table.column("conv"), "block": table.column("block"), "after": pa.array(out, pa.list_(pa.int64()))})

    def ways(table: pa.Table) -> pa.Table:
        table, items = items_of(table)
        end = np.array(table.column("after")[0].as_py())[None]
        _, levels, _ = ranked(items, cost_to_go(items, end[:, :, None])[:, :, 0], end)
        found = [int(exits(items, levels, np.array([s]))[0]) for s in range(4)]
        return pa.table({
            "conv": table.column("conv")[:1], "block": table.column("block")[:1], "after": table.column("after")[:1],
            "exits": pa.array([found], pa.list_(pa.int64())),
        })

    def forward(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        state, entry = 0, []
        for found in table.column("exits").to_pylist():
            entry.append(state)
            state = found[state]
        last = np.arange(len(entry)) == len(entry) - 1
        return pa.table({
            "conv": table.column("conv"), "block": table.column("block"), "after": table.column("after"),
            "entry": pa.array(entry, pa.int64()), "last": pa.array(last),
        })

    def solved(table: pa.Table) -> pa.Table:
        table, items = items_of(table)
        head = {c: table.column(c)[0].as_py() for c in ("block", "after", "entry", "last")}
        return steps_of(
            table, items, np.array([head["entry"]]), np.array([head["after"]]), np.array([head["last"]]), np.array([head["block"]])
        )

    at = ["conv", "block"]
    matrices = narrow.groupBy(*at).applyInArrow(matrix, "conv string, block long, costs array<bigint>")
    after = matrices.groupBy("conv").applyInArrow(backward, "conv string, block long, after array<bigint>")
    after = materialize(after, "dialogue-after")
    found = narrow.join(after, at).groupBy(*at).applyInArrow(ways, "conv string, block long, after array<bigint>, exits array<bigint>")
    entries = found.groupBy("conv").applyInArrow(
        forward, "conv string, block long, after array<bigint>, entry long, last boolean"
    )
    entries = materialize(entries, "dialogue-entries")
    return cut.drop("digest").join(entries, at).groupBy(*at).applyInArrow(solved, fields(STEP))


# ---- results ------------------------------------------------------------------------------------


def split_by_length(rows: DataFrame, short_rows: int, short_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Rows of conversations that go to tasks whole, and of those that are cut."""
    size = F.sum(F.octet_length("text").cast("long")).alias("bytes")
    sizes = rows.groupBy(F.col("conv").alias("c")).agg(F.count("*").alias("rows"), size)
    # written, so that the join knows its size: fewer than one in short_rows rows
    long = materialize(sizes.where((F.col("rows") > short_rows) | (F.col("bytes") > short_bytes)).select("c"), "dialogue-long")
    same = F.col("conv") == F.col("c")
    return rows.join(long, same, "left_anti"), rows.join(long, same, "left_semi")


def repair(rows: DataFrame, short_rows: int = SHORT_ROWS, short_bytes: int = SHORT_BYTES, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Steps of the short and of the long conversations from ``conv_id, turn, role, text`` and, if given, ``copies``.

    A step is one letter of an audit (a run of deleted copies has ``times``), with role and text after the edit, the
    row's turn, flaw and initial before it. ``block`` and ``step`` order the steps of a conversation. Those of
    the short ones stand in order within their partitions. The repaired conversation is all steps but Delete.
    """
    short, long = split_by_length(described(rows), short_rows, short_bytes)
    return whole(short), in_blocks(long, block_rows)


SUMMARY = (
    "conv string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class Account:
    """Sums of one conversation, step by step; beside the audit it holds a few numbers."""

    def __init__(self, conv: str, conv_id: int | None):
        self.conv, self.conv_id = conv, conv_id
        self.flaws, self.illegal, self.cost, self.audit = [0, 0, 0, 0], 0, 0, []
        self.low = self.high = self.before = None
        self.turns, self.begun, self.hash = 0, False, hashlib.sha256()

    def add(self, edit: str, times: int, role: str, text: str, turn: int | None, flaw: int, was: str | None) -> None:
        self.audit.append(edit * times)
        if edit == "I":
            self.cost += INSERT_COST
        else:
            self.flaws[flaw] += times
            if self.before is not None:
                self.illegal += self.before + was not in ("su", "ua", "au")
            self.illegal += times - 1  # a role never follows itself
            self.before = was
            if turn is not None and turn != self.high:
                self.low = turn if self.low is None else self.low
                self.high, self.turns = turn, self.turns + 1
            if edit == "D":
                self.cost += DELETE_COST * times
                return
            self.cost += (REROLE_COST if edit == "R" else KEEP_COST) + (TRUNCATED_COST if flaw == TRUNCATED else 0)
        self.hash.update(f"{'\n' if self.begun else ''}{role}:".encode())
        self.hash.update(text.encode())
        self.begun = True

    def line(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, self.conv_id, gaps, *self.flaws[1:], self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


def summed(steps: DataFrame) -> DataFrame:
    """``SUMMARY`` from steps that stand together and in order within their partition, as a stream."""
    schema = fields(SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, open_account, done = arrow_schema(schema), None, []

        def written() -> pa.RecordBatch:
            columns = zip(*done) if done else [[] for _ in target]
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)
            done.clear()
            return out

        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                part = batch.slice(first, 1000).to_pydict()
                for conv, conv_id, *rest in zip(*(part[c] for c in ("conv", "conv_id", "edit", "times", "role", "text", "turn", "flaw", "was"))):
                    if open_account is None or open_account.conv != conv:
                        if open_account is not None:
                            done.append(open_account.line())
                        open_account = Account(conv, conv_id)
                    open_account.add(*rest)
            if len(done) > 1000:
                yield written()
        if open_account is not None:
            done.append(open_account.line())
        yield written()

    return steps.mapInArrow(run, schema)


def report(rows: DataFrame, conversations: DataFrame, **limits: int) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``; without rows it has zeros, no audit and the hash of nothing."""
    short, long = repair(rows, **limits)
    ordered = long.repartition("conv").sortWithinPartitions("conv", "block", "step")
    found = summed(short).unionByName(summed(ordered)).drop("conv_id").withColumnRenamed("conv", "c")
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(found, F.coalesce(F.col("conv_id").cast("string"), F.lit("")) == F.col("c"), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
