"""Language-model scores by deleted interpolation of bigrams, unigrams and the uniform distribution.

P(w | v) = a2 c(v w) / c(v) + a1 c(w) / N + a0 / (V + 1), with weights of their own for each bucket of c(v) (powers of
two), learned by expectation-maximisation on a fold of the training documents that is deleted from the
counts for that purpose. The scores then use the counts of all training documents.

Counting and looking up move sorted arrays of hashed n-grams instead of single rows:

1. Documents are written once with the number of their chunk, a run of about ``CHUNK_BYTES`` within the task that reads them.
2. Each task counts the distinct n-grams of its chunks and sends them, sorted and cut into ranges of the hash. A frequent
   n-gram is one number per chunk. A chunk read by two tasks sends two rows for a range and gets one answer.
3. What is sent for a range meets in groups of about ``2**FAN_BITS`` chunks. A group adds up its counts, cuts its range
   further and hands on; the last level holds the corpus counts. They return by the same groups, in the order of the keys.
   Every level passes at most ``2 * 2**FAN_BITS`` rows a chunk, so rows grow with the input times its few levels.
4. Documents meet their chunk's answers and keep, packed, the count of each of their tokens and token pairs.
5. The weights come from a histogram of the deleted fold; its size is bounded by the grid of its bins.

N-grams are told apart by 56 bits of a hash: two of 10^8 share a number with a chance of about 10^-9 each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslens.llm.common import arrow_schema, crc_mod, fields, release, slices, space_words, utf8
from corpuslens.llm.superminhash import MULTIPLIER, WordHashes, mix
from corpuslens.sources.tables import materialize

#: Training folds: a document is held out if its remainder is HELD; of the others one in DELETED teaches the weights.
FOLDS, HELD, DELETED = 7, 2, 10
KEY_BITS = 56
#: Text of a chunk, in bytes; a task's arrays take about 15 times as much.
CHUNK_BYTES = 8 << 20
#: What a document counts beyond its text, so that empty ones fill a chunk too.
LEAST_BYTES = 16
#: A level cuts a hash range into this power of two, and puts together as many chunks.
FAN_BITS = 8
#: Context counts from 2^(BUCKETS - 2) on share the last bucket.
BUCKETS = 24
#: Bins per factor of two in the histogram of the deleted fold, and the smallest probability told apart.
FINENESS, DEPTH = 8, 48
STEPS = 200

# not words: words hold no white space
START, END = np.uint64(0x5354415254), np.uint64(0x454E44)

SENT = "p long, kind int, bucket long, keys binary, n binary, h binary"
ANSWER = "p long, kind int, bucket long, n binary, h binary, distinct long, total long"
COUNTED = "doc_id long, held_out boolean, tokens long, words binary, pairs binary, kept_words binary, kept_pairs binary"
BINS = "bucket int, two int, one int, times long"


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, compressed: high bytes of small numbers cost nothing."""
    planes = np.ascontiguousarray(values.astype("<u8").view("u1").reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "u1").reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def shorten(keys: np.ndarray) -> np.ndarray:
    return mix(keys) >> np.uint64(64 - KEY_BITS)


class Sequences:
    """Texts as word numbers; keys of their words and neighbouring pairs, an end token behind each text."""

    def __init__(self, texts: list[bytes]):
        pool = WordHashes()
        split = [pool.numbered(space_words(t)) for t in texts]
        hashed = np.concatenate([pool.hashes(), [END, START]])
        end, start = len(hashed) - 2, len(hashed) - 1
        self.lengths = np.array([len(s) + 1 for s in split], "int64")
        self.words = np.empty(int(self.lengths.sum()), "int32")
        at = 0
        for numbers in split:
            self.words[at : at + len(numbers)] = numbers
            at += len(numbers) + 1
            self.words[at - 1] = end
        del split
        before = np.empty_like(self.words)
        before[1:] = self.words[:-1]
        before[np.cumsum(self.lengths) - self.lengths] = start
        self.keys = shorten(hashed)
        pairs = hashed[before]
        pairs *= MULTIPLIER
        pairs += hashed[self.words]
        pairs += np.uint64(1)
        self.pairs = shorten(pairs)


def totals(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and each column of counts added up."""
    if not len(keys):
        return (keys, *counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(c[order], first) for c in counts))


def ranged(p: int, kind: int, bits: int, keys: np.ndarray, n: np.ndarray, h: np.ndarray) -> list[tuple]:
    """A row for each range of sorted keys; the highest ``bits`` of a key name its range."""
    ranges = keys >> np.uint64(KEY_BITS - bits)
    edges = [0, *(np.flatnonzero(ranges[1:] != ranges[:-1]) + 1).tolist(), len(keys)]
    return [
        (p, kind, int(ranges[a]), pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(n[a:b]), pack(h[a:b]))
        for a, b in zip(edges, edges[1:]) if b > a
    ]


def table_of(rows: list[tuple], target: pa.Schema) -> pa.Table:
    columns = zip(*rows) if rows else ([] for _ in target)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)


def counted_keys(texts: list[bytes], train: list[bool], deleted: list[bool]) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """Keys of words and of pairs with their counts in training texts and in deleted ones, which are part of them."""
    seq = Sequences(texts)
    n, h = np.repeat(train, seq.lengths).astype("int32"), np.repeat(deleted, seq.lengths).astype("int32")
    size = len(seq.keys)
    of_words = np.bincount(seq.words, n, size).astype("int32"), np.bincount(seq.words, h, size).astype("int32")
    # as a context the start of a text counts once per text; it is asked for like a word but is none
    of_words[0][-1], of_words[1][-1] = sum(train), sum(deleted)
    return totals(seq.keys, *of_words), totals(seq.pairs, n, h)


def dealt(chunk_bytes: int, schema: T.StructType):
    """Rows with the chunk ``p`` in which their text begins. The name is stored, so it need not be the same in a repeated task."""
    target = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            own = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype("int64") + LEAST_BYTES
            ends = size + np.cumsum(own)
            size = int(ends[-1]) if len(ends) else size
            columns = [batch.column(f.name).cast(f.type) for f in list(target)[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(first + (ends - own) // chunk_bytes)], schema=target)

    return run


def send(bits: int):
    target = arrow_schema(fields(SENT))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, ([], [])

        def flushed() -> Iterator[pa.RecordBatch]:
            rows = []
            for kind, found in enumerate(held):
                if found:
                    rows += ranged(current, kind, bits, *totals(*(np.concatenate([part[c] for part in found]) for c in range(3))))
                    found.clear()
            release()
            if rows:
                yield from table_of(rows, target).to_batches()

        for batch in slices(batches, "text"):
            texts = [t or b"" for t in utf8(batch.column("text"))]
            names = batch.column("p").to_numpy()
            train, deleted = (batch.column(c).to_pylist() for c in ("train", "deleted"))
            edges = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
            for a, b in zip(edges, edges[1:]):
                if names[a] != current:
                    yield from flushed()
                    current = int(names[a])
                for found, part in zip(held, counted_keys(texts[a:b], train[a:b], deleted[a:b])):
                    found.append(part)
        yield from flushed()

    return run


def keys_sent(group: pa.Table) -> list[np.ndarray]:
    return [np.cumsum(unpack(k)) for k in group.column("keys").to_pylist()]


def added(group: pa.Table, sent: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    return totals(np.concatenate(sent), *(np.concatenate([unpack(x) for x in group.column(c).to_pylist()]).astype("int64") for c in ("n", "h")))


def replies(group: pa.Table, sent: list[np.ndarray], keys: np.ndarray, n: np.ndarray, h: np.ndarray) -> list[tuple]:
    """The counts of each sender's distinct keys, in their order."""
    kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
    owned: dict[int, list[np.ndarray]] = {}
    for p, own in zip(group.column("p").to_pylist(), sent):
        owned.setdefault(p, []).append(own)
    rows = []
    for p, own in owned.items():
        at = np.searchsorted(keys, own[0] if len(own) == 1 else np.unique(np.concatenate(own)))
        rows.append((p, kind, bucket, pack(n[at]), pack(h[at]), 0, 0))
    return rows


def merge(group: pa.Table) -> pa.Table:
    """The counts of a range over the whole corpus, given back to each sender in the order of its keys.

    One more row without a sender tells how many keys were seen in training, and how often (of words only).
    """
    sent = keys_sent(group)
    keys, n, h = added(group, sent)
    kind, bucket = group.column("kind")[0].as_py(), group.column("bucket")[0].as_py()
    rows = replies(group, sent, keys, n, h)
    word = keys != shorten(np.array([START]))[0] if kind == 0 else np.zeros(len(keys), bool)
    rows.append((None, kind, bucket, None, None, int((n[word] > 0).sum()), int(n[word].sum())))
    del sent, keys, n, h
    release()
    return table_of(rows, arrow_schema(fields(ANSWER)))


def handed_on(bits: int):
    """The counts of a range over a group of senders, cut into ranges of ``bits``; the group is their sender."""

    def run(group: pa.Table) -> pa.Table:
        rows = ranged(group.column("to")[0].as_py(), group.column("kind")[0].as_py(), bits, *added(group, keys_sent(group)))
        release()
        return table_of(rows, arrow_schema(fields(SENT)))

    return run


def returned(group: pa.Table, answers: pa.Table) -> pa.Table:
    """The answers to a group, given back to its senders."""
    sent = keys_sent(group)
    keys = np.unique(np.concatenate(sent))
    answers = answers.sort_by("bucket")
    n, h = (np.concatenate([unpack(x) for x in answers.column(c).to_pylist()]).astype("int64") for c in ("n", "h"))
    rows = replies(group, sent, keys, n, h)
    del sent, keys, n, h
    release()
    return table_of(rows, arrow_schema(fields(ANSWER)))


def answered(sent: DataFrame, senders: int, bits: int, fan_bits: int) -> tuple[DataFrame, DataFrame]:
    """The corpus counts of everything sent, and the totals of each range. ``senders``: how many sent to one range.

    Senders are counted once each, whatever the number of their rows.
    """
    groups = -(-senders // (1 << fan_bits))
    if groups <= 1 or bits + fan_bits > KEY_BITS:
        answers = materialize(sent.groupBy("kind", "bucket").applyInArrow(merge, fields(ANSWER)), "answers")
        return answers.where("p IS NOT NULL"), answers.where("p IS NULL AND kind = 0")
    member = F.pmod(F.xxhash64("p"), F.lit(groups).cast("long"))
    named = sent.withColumn("to", (F.col("bucket") * groups + member) * 2 + F.col("kind"))
    above = materialize(named.groupBy("to").applyInArrow(handed_on(bits + fan_bits), fields(SENT)), "ranges")
    answers, seen = answered(above, groups, bits + fan_bits, fan_bits)
    back = named.groupBy("to").cogroup(answers.groupBy("p")).applyInArrow(returned, fields(ANSWER))
    return materialize(back, "answers"), seen


def attach(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Each document of a chunk with the counts of its words and pairs; without its own fold if that is deleted."""
    target = arrow_schema(fields(COUNTED))
    if not docs.num_rows:
        return target.empty_table()
    texts = [t or b"" for t in utf8(docs.column("text").combine_chunks())]
    seq = Sequences(texts)
    answers = answers.sort_by([("kind", "ascending"), ("bucket", "ascending")])
    kinds = answers.column("kind").to_numpy()
    got = {c: [unpack(x) for x in answers.column(c).to_pylist()] for c in ("n", "h")}
    whole = {(c, kind): np.concatenate([a for a, k in zip(got[c], kinds) if k == kind]).astype("int64") for c in ("n", "h") for kind in (0, 1)}
    del got, answers
    distinct, at_word = np.unique(seq.keys, return_inverse=True)
    pairs, at_pair = np.unique(seq.pairs, return_inverse=True)
    if len(distinct) != len(whole["n", 0]) or len(pairs) != len(whole["n", 1]):
        raise RuntimeError("a chunk's answers do not fit its documents")
    words = {c: whole[c, 0][at_word][seq.words] for c in ("n", "h")}
    twos = {c: whole[c, 1][at_pair] for c in ("n", "h")}
    ends = np.cumsum(seq.lengths)
    rows = []
    for n, (doc_id, held_out, deleted) in enumerate(zip(*(docs.column(c).to_pylist() for c in ("doc_id", "held_out", "deleted")))):
        cut = slice(int(ends[n] - seq.lengths[n]), int(ends[n]))
        kept = (pack(words["n"][cut] - words["h"][cut]), pack(twos["n"][cut] - twos["h"][cut])) if deleted else (None, None)
        rows.append((doc_id, held_out, cut.stop - cut.start, pack(words["n"][cut]), pack(twos["n"][cut]), *kept))
    del seq, texts, whole, words, twos, distinct, at_word, pairs, at_pair
    release()
    return table_of(rows, target)


def contexts(words: np.ndarray, starts: int) -> np.ndarray:
    """Count of what stands before each token: the word before it, or the start of the text."""
    return np.concatenate([[starts], words[:-1]])


def bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count.astype("float64"))[1], BUCKETS - 1)


def parts(words: np.ndarray, pairs: np.ndarray, starts: int, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context bucket, bigram and unigram estimate of each token."""
    before = contexts(words, starts)
    return bucket(before), pairs / np.maximum(before, 1), words / max(total, 1)


def binned(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        value = np.round(np.log2(p) * FINENESS)
    return np.where(p > 0, np.maximum(value, -DEPTH * FINENESS), 1).astype("int64")


def unbinned(bins: np.ndarray) -> np.ndarray:
    return np.where(bins > 0, 0.0, 2.0 ** (np.minimum(bins, 0) / FINENESS))


def histogram(total: int, starts: int):
    """Of the deleted fold: how often each bin of (context bucket, bigram, unigram estimate) occurs."""
    target = arrow_schema(fields(BINS))
    width = DEPTH * FINENESS + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.empty(0, "int64"), np.empty(0, "int64")
        for batch in batches:
            found = [keys]
            for words, pairs in zip(batch.column("kept_words").to_pylist(), batch.column("kept_pairs").to_pylist()):
                b, two, one = parts(unpack(words).astype("int64"), unpack(pairs).astype("int64"), starts, total)
                found.append((b * width + binned(two) + width - 2) * width + binned(one) + width - 2)
            weights = np.concatenate([times, np.ones(sum(map(len, found[1:])), "int64")])
            keys, times = totals(np.concatenate(found), weights)
        if len(keys):
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys // width**2, pa.int32()), pa.array(keys // width % width - width + 2, pa.int32()), pa.array(keys % width - width + 2, pa.int32()), pa.array(times)], schema=target)

    return run


def weights(bins: np.ndarray, two: np.ndarray, one: np.ndarray, times: np.ndarray, distinct: int, steps: int = STEPS) -> np.ndarray:
    """(BUCKETS, 3) mixture weights of bigram, unigram and uniform, by expectation-maximisation.

    Buckets that the fold does not show take the weights of all buckets together; an unseen context has no
    bigram share. The uniform share never falls below a millionth, so that no score is infinite.
    """
    out = np.tile([0.4, 0.4, 0.2], (BUCKETS, 1))
    out[0] = [0.0, 0.8, 0.2]
    each = np.stack([two, one, np.full(len(two), 1 / (distinct + 1))])

    def learn(chosen: np.ndarray, start: np.ndarray) -> np.ndarray:
        mix_ = start.copy()
        for _ in range(steps):
            share = mix_[:, None] * each[:, chosen]
            share *= times[chosen] / share.sum(axis=0)
            new = np.maximum(share.sum(axis=1) / times[chosen].sum(), [0, 0, 1e-6])
            new /= new.sum()
            if np.abs(new - mix_).max() < 1e-9:
                return new
            mix_ = new
        return mix_

    seen = bins > 0
    if seen.any():
        out[1:] = learn(seen, out[1])
    for b in np.unique(bins).tolist():
        out[b] = learn(bins == b, out[b] if b else np.array([0.0, 0.8, 0.2]))
    return out


def scorer(mixture: np.ndarray, total: int, distinct: int, starts: int):
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    target = arrow_schema(fields(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, held_out, packed, packed_pairs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "words", "pairs"))):
                words, pairs = unpack(packed).astype("int64"), unpack(packed_pairs).astype("int64")
                b, two, one = parts(words, pairs, starts, total)
                p = mixture[b, 0] * two + mixture[b, 1] * one + mixture[b, 2] / (distinct + 1)
                base = np.log10((words + 1) / (total + distinct + 1)).sum()
                rows.append((doc_id, held_out, len(words), int((words > 0).sum()), total, float(base), float(np.log10(p).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)

    return run, schema


def score(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, fan_bits: int = FAN_BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per input row.

    Null and empty texts are an end token alone. A null id counts as empty text in folds and stays null. An empty
    table gives an empty result; without training documents all counts are 0 and scores are uniform. Columns
    other than doc_id and text are not read. How the input is split into tasks does not change the result.
    """
    spark = docs.sparkSession
    held = crc_mod(F.col("doc_id"), FOLDS) == HELD
    deleted = F.pmod((F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) / FOLDS).cast("long"), F.lit(DELETED)) == 0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select("doc_id", "text", held.alias("held_out"), (~held).alias("train"), (~held & deleted).alias("deleted"))
    named = fields("doc_id long, text string, held_out boolean, train boolean, deleted boolean, p long")
    chunks = materialize(rows.mapInArrow(dealt(chunk_bytes, named), named), "chunks")
    sums = chunks.agg(F.countDistinct("p").alias("chunks"), F.count_if("train").alias("docs"), F.count_if("deleted").alias("deleted")).first()
    if not sums["chunks"]:
        return spark.createDataFrame([], "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    sent = chunks.select("text", "train", "deleted", "p").mapInArrow(send(fan_bits), fields(SENT))
    answers, ranges = answered(sent, sums["chunks"], fan_bits, fan_bits)
    seen = ranges.agg(F.sum("distinct").alias("distinct"), F.sum("total").alias("total")).first()
    distinct, total = seen["distinct"] or 0, seen["total"] or 0
    met = chunks.select("p", "doc_id", "text", "held_out", "deleted").groupBy("p").cogroup(answers.groupBy("p"))
    counted = materialize(met.applyInArrow(attach, fields(COUNTED)), "counted")
    # the deleted fold's own tokens are not part of what its estimates divide by
    fold = counted.where("kept_words IS NOT NULL")
    gone = fold.agg(F.sum("tokens")).first()[0] or 0
    kept_total, kept_starts = total - gone, sums["docs"] - sums["deleted"]
    bins = fold.mapInArrow(histogram(kept_total, kept_starts), fields(BINS)).groupBy("bucket", "two", "one").agg(F.sum("times").alias("times")).orderBy("bucket", "two", "one").toArrow()
    b, two, one, times = (bins.column(c).to_numpy() for c in ("bucket", "two", "one", "times"))
    mixture = weights(b, unbinned(two), unbinned(one), times.astype("float64"), distinct)
    run, schema = scorer(mixture, total, distinct, sums["docs"])
    return counted.mapInArrow(run, fields(schema))
