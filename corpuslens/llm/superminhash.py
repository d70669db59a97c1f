"""Word shingles as 64-bit hashes and their SuperMinHash signatures, in numpy over a run of texts.

SuperMinHash gives every element a random permutation of the m slots and puts the value ``j + r`` (r uniform
in [0, 1)) into the j-th slot of that permutation; a slot keeps its minimum. Slots of one element so get
different ranks, which lowers the variance for small sets. Here all elements of many texts take step j
together; a text leaves as soon as no slot of its own holds a value of j or more, since later steps only
bring larger ones.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import xxhash

GOLDEN = 0x9E3779B97F4A7C15
MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; each distinct word of a run is hashed once."""

    def __init__(self):
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__

    def numbered(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.__getitem__, words), "int64", len(words))

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(w) for w in self.numbers), "uint64", len(self.numbers))


def shingle_sets(texts: list[list[bytes]], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each word list; a shorter list is one shingle, an empty one none."""
    pool = WordHashes()
    numbers = [pool.numbered(words) for words in texts]
    table = pool.hashes()
    return [shingles(table[n], width) for n in numbers]


def shingles(hashed: np.ndarray, width: int) -> np.ndarray:
    if not len(hashed):
        return hashed
    span = min(width, len(hashed))
    count = len(hashed) - span + 1
    rolled = np.full(count, np.uint64(span))
    for at in range(span):
        rolled = rolled * MULTIPLIER + hashed[at : at + count]
    rolled = np.sort(mix(rolled))
    return rolled[np.concatenate([[True], rolled[1:] != rolled[:-1]])]


def signatures(sets: list[np.ndarray], slots: int, group: int = 100_000) -> np.ndarray:
    """One row of ``slots`` values per set; rows of empty sets stay unset."""
    out = np.full((len(sets), slots), UNSET)
    first, held = 0, 0
    for at, elements in enumerate(sets):
        held += len(elements)
        if held >= group or at == len(sets) - 1:
            sign(sets[first : at + 1], out[first : at + 1])
            first, held = at + 1, 0
    return out


def sign(sets: list[np.ndarray], out: np.ndarray) -> None:
    slots = out.shape[1]
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, "uint64")
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order: np.ndarray | None = None  # the part of each element's permutation that later steps may read
    for step in range(slots):
        if not len(elements):
            return
        drawn = mix(elements + np.uint64((step + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF))
        pick = step + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype("int64")
        if order is None:
            place = pick
        else:
            row = np.arange(len(elements))
            place = order[row, pick].astype("int64")
            order[row, pick] = order[row, step]
        value = (np.uint64(step) << np.uint64(32)) | (drawn >> np.uint64(32))
        np.minimum.at(flat, owner * slots + place, value)
        open_ = out.max(axis=1) >= (np.uint64(step + 1) << np.uint64(32))
        stay = open_[owner]
        if not stay.all():
            elements, owner, pick = elements[stay], owner[stay], pick[stay]
            order = order[stay] if order is not None else None
        if order is None and len(elements):
            order = np.tile(np.arange(slots, dtype="int16" if slots > 255 else "uint8"), (len(elements), 1))
            order[np.arange(len(elements)), pick] = 0
