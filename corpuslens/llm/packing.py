"""Best-fit packing of token pieces, certified by dual-feasible bounds.

1. ``token_pieces`` turns each text into token ids and cuts only what is longer than a sequence.
2. Pieces are dealt to parts of about ``part_rows`` by a hash. Each part runs best-fit decreasing.
3. Dual-feasible functions give a lower bound on the part's bins. A part that meets its bound is certified.
4. Parts with a gap release all bins that are not full, certified parts only their emptiest bin. Released
   bins move whole to new, fewer parts, which mix what several parts had left, and are packed again. A part
   keeps its new packing only if it has fewer bins, so no round makes the result worse.

Only narrow rows (a few numbers per piece) are shuffled; texts never are.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.common import CACHES, arrow_schema, fields, slices, trim, utf8
from corpuslens.sources.tables import materialize

CAPACITY = 2048
PART_ROWS = 50_000
#: Exchange ends after so many rounds in a row that saved no sequence.
PATIENCE = 2
#: Bytes of words and ids that a worker remembers, with what Python needs to hold an entry. Only time depends on it.
CACHE_BYTES, ENTRY_BYTES = 128 << 20, 110

PACKED = "row_no long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long, part long, round int, part_bins long, part_bound long, release boolean"


#: Latin words with at most one mark behind them: one or two pre-tokens, whose last tokens carry the word end.
PLAIN = re.compile("[A-Za-z\u00df-\u00f6\u00f8-\u00ff\u00c0-\u00d6\u00d8-\u00de]+([.,;:!?])?")


class WordEncoder:
    """Ids of whole texts, put together from remembered words.

    No token of a pre-tokenised byte-pair vocabulary crosses white space, so the ids of a text are those of its
    space-separated chunks in order. New plain words are encoded in one call as one text and parted at the tokens
    that end a word; other chunks, and all chunks of a vocabulary without word ends, are encoded one by one.
    """

    def __init__(self, path: str, limit: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit, self.known, self.held = Tokenizer.from_file(path), limit, {}, 0
        # read from the text: the whole vocabulary as Python objects would stay in the worker's memory
        found = re.search(r'"end_of_word_suffix":\s*("(?:[^"\\]|\\.)*")', self.tokenizer.to_str())
        suffix = json.loads(found[1]) if found else None
        self.ends = None
        if suffix:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[n for token, n in vocabulary.items() if token.endswith(suffix)]] = True

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [text.split() for text in texts]
        if self.held > self.limit:
            self.known, self.held = {}, 0
        known = self.known
        plain, marked, other = [], [], []
        for word in set().union(*split).difference(known) if split else ():
            text = word.decode("utf-8", "replace")
            match = PLAIN.fullmatch(text) if self.ends is not None else None
            (other if match is None else marked if match[1] else plain).append((word, text))
        for words, pretokens in ((plain, 1), (marked, 2)):
            if words:
                joined = self.tokenizer.encode_batch_fast([" ".join(t for _, t in words)], add_special_tokens=False)[0]
                ids = np.array(joined.ids, "<u4")
                cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4)[pretokens - 1 :: pretokens].tolist()
                data, first = ids.tobytes(), 0
                for (word, _), cut in zip(words, cuts, strict=True):
                    known[word] = data[first:cut]
                    self.held += len(word) + cut - first + ENTRY_BYTES
                    first = cut
        for first in range(0, len(other), 10_000):
            words = other[first : first + 10_000]
            coded = self.tokenizer.encode_batch_fast([t for _, t in words], add_special_tokens=False)
            for (word, _), code in zip(words, coded):
                known[word] = np.array(code.ids, "<u4").tobytes()
                self.held += len(word) + len(known[word]) + ENTRY_BYTES
        for words in split:
            yield b"".join([known[w] for w in words])


@functools.cache
def encoder(path: str) -> WordEncoder:
    """One per worker process, so that its words stay known from task to task."""
    return WordEncoder(path)


CACHES.append(encoder.cache_clear)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: row_no (unique), doc_id, piece, start, length, ids_crc32.

    A null text counts as empty: its one piece is the end id. Repeated rows give repeated pieces with row
    numbers of their own; null keys stay null.
    """
    schema = fields("row_no long, doc_id long, piece int, start long, length long, ids_crc32 long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, target = encoder(tokenizer), arrow_schema(schema)
        row_no = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "__text", 2 << 20):
            rows = []
            keys = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(keys, words.encode([data or b"" for data in utf8(batch.column("__text"))])):
                ids += end
                for piece, first in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[first : first + 4 * capacity]
                    rows.append((row_no, doc_id, piece, first // 4, len(cut) // 4, zlib.crc32(cut)))
                    row_no += 1
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)
        trim()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, schema)


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """Best bound of two families of dual-feasible functions on the number of bins.

    * f_q: sizes above capacity - q count as a whole bin, sizes below q as nothing, others as they are;
    * u_k: x counts as x if (k + 1) x is a whole number of bins, else as floor((k + 1) x) / k.
    The identity is f_0. Sums stay whole numbers: no rounding can lift a bound.
    """
    return histogram_bound(*np.unique(lengths.astype("int64"), return_counts=True), capacity)


def histogram_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """``lower_bound`` of distinct sizes and how often each occurs."""
    if not len(sizes):
        return 0
    best = -(-int((sizes * counts).sum()) // capacity)
    for q in np.unique(np.concatenate([sizes[sizes * 2 <= capacity], capacity - sizes[sizes * 2 > capacity] + 1])):
        if 0 < q * 2 <= capacity:
            value = np.where(sizes > capacity - q, capacity, np.where(sizes < q, 0, sizes))
            best = max(best, -(-int((value * counts).sum()) // capacity))
    for k in range(1, 21):
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, (scaled // capacity) * capacity)  # times k
        best = max(best, -(-int((value * counts).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin number and offset of each piece; equal lengths keep their order.

    Open bins hang in lists by free space; a bit mask names the lists in use, so the tightest fit is the
    lowest set bit at or above the piece's length.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.empty(len(lengths), "int64"), np.empty(len(lengths), "int64")
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, opened = 0, 0
    for at, length in zip(order.tolist(), lengths[order].tolist()):
        fits = mask >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            number = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            number, room, opened = opened, capacity, opened + 1
        bins[at], places[at] = number, capacity - room
        rest = room - length
        if rest:
            free[rest].append(number)
            mask |= 1 << rest
    return bins, places


def pack_part(number: int, capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("row_no", "ascending")])
        lengths, rows = group.column("length").to_numpy(), group.column("row_no").to_numpy()
        bins, places = best_fit_decreasing(lengths, capacity)
        found = int(bins.max()) + 1
        before = group.column("sequence_id").to_numpy()
        if number and found >= len(np.unique(before)):  # no better: keep the packing of the round before
            sequence, places = before, group.column("offset").to_numpy()
            found = len(np.unique(before))
        else:
            sequence = rows[np.unique(bins, return_index=True)[1]][bins]
        _, which = np.unique(sequence, return_inverse=True)
        fill = np.bincount(which, lengths)[which].astype("int64")
        full = np.full(len(rows), 1, "int64")
        values = {
            "sequence_id": sequence, "offset": places, "fill": fill, "round": full.astype("int32") * number,
            "part_bins": full * found, "part_bound": full * (bound := lower_bound(lengths, capacity)),
            "release": (fill < capacity) & ((found > bound) | (sequence == sequence[np.argmin(fill)])),
        }
        target = arrow_schema(fields(PACKED))
        return pa.Table.from_arrays([pa.array(values[f.name], f.type) if f.name in values else group.column(f.name).cast(f.type) for f in target], schema=target)

    return run


def length_bound(pieces: DataFrame, capacity: int) -> int:
    """Least number of sequences for all pieces, from the histogram of their lengths (at most ``capacity`` numbers)."""
    counts = pieces.groupBy("length").count().collect()
    return histogram_bound(*(np.array([r[c] for r in counts], "int64") for c in ("length", "count")), capacity)


def pack(pieces: DataFrame, capacity: int = CAPACITY, part_rows: int = PART_ROWS) -> DataFrame:
    """Pieces with sequence_id and offset, and the count and bound of the part that packed them.

    A sequence is numbered by the row_no of one of its pieces. Pieces as long as a sequence stand alone. Rounds of
    exchange end when the bound over all pieces is met, when one part holds all that is open, or when ``PATIENCE``
    rounds in a row saved nothing. An empty input gives an empty result.
    """
    pieces = materialize(pieces, "pieces")
    whole = F.col("length") == capacity
    alone = pieces.where(whole).select("*", F.col("row_no").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.col("length").alias("fill"), F.lit(-1).cast("long").alias("part"), F.lit(0).alias("round"), F.lit(1).cast("long").alias("part_bins"), F.lit(1).cast("long").alias("part_bound"), F.lit(False).alias("release"))
    todo = pieces.where(~whole).withColumns({"sequence_id": F.col("row_no"), "offset": F.lit(0).cast("long")})
    bound, count = length_bound(pieces.where(~whole), capacity), todo.count()
    done, settled, least, idle, number = alone, 0, None, 0, 0
    while count:
        parts = -(-count // part_rows)
        # released bins stay whole: they are dealt by their sequence; the round stirs the hash
        dealt = todo.withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(number)), F.lit(parts)))
        packed = materialize(dealt.groupBy("part").applyInArrow(pack_part(number, capacity), PACKED), "packed")
        # every sequence has one piece at offset 0
        first, free = F.col("offset") == 0, F.col("release")
        state = packed.agg(F.count_if(first).alias("bins"), F.count_if(first & free).alias("open"), F.count_if(free).alias("rows")).first()
        total = settled + state["bins"]
        idle = idle + 1 if least is not None and total >= least else 0
        if parts == 1 or total <= bound or idle == PATIENCE:
            return done.unionByName(packed)
        done, least = done.unionByName(packed.where("NOT release")), total
        todo = packed.where("release").select("row_no", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
        settled, count, number = settled + state["bins"] - state["open"], state["rows"], number + 1
    return done


def packed_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset and the round that packed it.

    Null and empty texts are the end id alone; null ids stay; repeated rows are packed each time. An empty table
    gives an empty result. Other columns are not read.
    """
    packed = pack(token_pieces(docs, tokenizer, capacity), capacity)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "round", "part_bins", "part_bound")


def id_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, tokens: how many ids each text has, without an end id; null texts have none."""
    schema = fields("doc_id long, source string, lang string, tokens long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, target = encoder(tokenizer), arrow_schema(schema)
        for batch in slices(batches, "__text", 2 << 20):
            counts = [len(ids) // 4 for ids in words.encode([data or b"" for data in utf8(batch.column("__text"))])]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).cast(target.field(c).type) for c in ("doc_id", "source", "lang")], pa.array(counts, pa.int64())], schema=target)

    return rows.mapInArrow(run, schema)
