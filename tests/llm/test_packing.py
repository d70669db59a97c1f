import random
import zlib

import numpy as np
import pytest

from corpuslens.llm import packing
from corpuslens.llm.queries import tokenizer_path


def layout(rows, capacity):
    """Sequences are gapless from 0 and never over capacity; gives their number."""
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_pieces_equal_whole_encoding(spark, odd_docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = [r["text"] for r in odd_docs.select("text").collect()] + ["A<|endoftext|>b <|ENDOFTEXT|> isn't, J̌ İ x.y!? ...,; 12,5 a b", "<|startoftext|>", "don't. can't! (re) we've,"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = set()
    for n, text in enumerate(texts):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for piece, start in enumerate(range(0, len(ids), 100)):
            cut = ids[start : start + 100]
            want.add((n, piece, start, len(cut), zlib.crc32(cut.tobytes())))
    rows = packing.token_pieces(docs, tokenizer_path(), 100).collect()
    assert {tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


@pytest.mark.parametrize("part_rows", [10_000, 40])
def test_packing_places_every_piece_once(spark, part_rows):
    generator = random.Random(3)
    lengths = [generator.choice([generator.randint(1, 100), generator.randint(30, 60), 100]) for _ in range(400)]
    pieces = spark.createDataFrame([(n, n // 2, n % 2, 0, size, 7) for n, size in enumerate(lengths)], "row_no long, doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = packing.pack(pieces, 100, part_rows).collect()
    assert sorted(r["row_no"] for r in rows) == list(range(400))
    assert all(r["length"] == lengths[r["row_no"]] for r in rows)
    bins = layout(rows, 100)
    best = packing.lower_bound(np.array(lengths), 100)
    assert best <= bins <= best * 1.06 + 1


def test_bounds_hold_and_beat_the_sum():
    generator = np.random.default_rng(1)
    for _ in range(30):
        lengths = generator.integers(1, 101, generator.integers(1, 60))
        bins, places = packing.best_fit_decreasing(lengths, 100)
        fill = np.bincount(bins, lengths)
        assert fill.max() <= 100 and packing.lower_bound(lengths, 100) <= len(fill)
    assert packing.lower_bound(np.array([51] * 10), 100) == 10
    assert packing.lower_bound(np.array([34] * 9), 100) == 5
    assert packing.lower_bound(np.array([], "int64"), 100) == 0


def test_edges(spark, odd_docs, no_docs):
    rows = packing.packed_documents(odd_docs, tokenizer_path()).collect()
    layout(rows, packing.CAPACITY)
    assert {r["doc_id"] for r in rows} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
    assert sum(r["doc_id"] == 2 for r in rows) == 2 and [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    assert packing.packed_documents(no_docs, tokenizer_path()).count() == 0


def test_exchange_goes_on_until_it_saves_nothing(spark):
    generator = random.Random(8)
    lengths = [generator.randint(1, 70) for _ in range(900)]
    pieces = spark.createDataFrame([(n, n, 0, 0, size, 7) for n, size in enumerate(lengths)], "row_no long, doc_id long, piece int, start long, length long, ids_crc32 long")
    assert packing.length_bound(pieces, 100) == packing.lower_bound(np.array(lengths), 100)
    rows = packing.pack(pieces, 100, part_rows=30).collect()
    assert sorted(r["row_no"] for r in rows) == list(range(900))
    one_part = len(np.unique(packing.best_fit_decreasing(np.array(lengths), 100)[0]))
    assert layout(packing.pack(pieces, 100).collect(), 100) == one_part
    first_round = sum({r["part"]: r["part_bins"] for r in packing.pack(pieces, 100, part_rows=30).collect() if r["round"] == 0}.values())
    assert one_part <= layout(rows, 100) <= min(first_round, one_part * 1.05 + 1) and max(r["round"] for r in rows) >= 1
