"""Terms of Arrow batches, counted by code instead of one by one.

Words of a batch are dictionary-encoded first: an n-gram of characters is a function of its word, so it is cut once for each
distinct word, and an n-gram of words is a pair of codes. What is counted are sorted integers; no term becomes a Python
string before it is distinct. The terms are those of ``tokens.char_ngrams`` and ``tokens.ngram_range``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts and words that are counted at once: a batch may hold ten thousand long rows.
RUN_BYTES, RUN_WORDS = 1 << 21, 1 << 19
_LIMIT = 1 << 62


def runs(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of rows (start, length) of about ``limit`` in size, one row at least; together all rows."""
    if not len(sizes):
        return []
    block = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(sizes)]
    return [(first, last - first) for first, last in zip(cuts, cuts[1:])]


def sizes_of(column: pa.Array) -> np.ndarray:
    """Bytes of texts, numbers of words of arrays; none for nulls."""
    listed = pa.types.is_list(column.type) or pa.types.is_large_list(column.type)
    sizes = pc.list_value_length(column) if listed else pc.binary_length(column)
    return pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def flattened(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of every word, its code, the distinct words) of a column of word arrays."""
    lengths = sizes_of(lists)
    encoded = lists.flatten().dictionary_encode()
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(lengths)), lengths), codes, encoded.dictionary


def counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.r_[first, len(keys)])


def summed(keys: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of the amounts of each."""
    if not len(keys):
        return keys, amounts
    if keys.max() < 1 << 32 and amounts.max() < 1 << 30:  # both in one number, which sorts several times faster
        both = np.sort(keys << 30 | amounts)
        keys, amounts = both >> 30, both & ((1 << 30) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, amounts = keys[order], amounts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(amounts, first)


def expanded(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, … of every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def word_grams(words: list[str], low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Character n-grams of distinct words, each padded with a space on both sides.

    Returns (word, gram, occurrences) in the order of words, and the distinct grams. A padded word shorter than ``low``
    counts once, whole.
    """
    text = "".join(f" {w} " for w in words)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(owner))
    letters, code = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), return_inverse=True)
    key, size = code.astype(np.int64), len(letters)
    grams: list[str] = []
    held, ids = [], []
    for n in range(2, high + 1):
        at = np.flatnonzero(left >= n)
        if size * len(letters) >= _LIMIT:
            found, key = np.unique(key, return_inverse=True)
            size = len(found)
        longer = np.zeros(len(key), np.int64)
        longer[at] = key[at] * len(letters) + code[at + n - 1]
        key, size = longer, size * len(letters)
        if n >= low:
            found = pa.array(key[at]).dictionary_encode()
            gram = found.indices.to_numpy()
            sample = np.zeros(len(found.dictionary), np.int64)
            sample[gram] = at
            held.append(owner[at])
            ids.append(gram.astype(np.int64) + len(grams))
            grams += [text[p : p + n] for p in sample.tolist()]
    short = np.flatnonzero(sizes < low)
    held.append(short)
    ids.append(np.arange(len(short)) + len(grams))
    grams += [f" {words[w]} " for w in short.tolist()]
    pairs, occurrences = counted(np.concatenate(held) * max(len(grams), 1) + np.concatenate(ids))
    word, gram = np.divmod(pairs, max(len(grams), 1))
    return word, gram, occurrences, grams


@dataclass(frozen=True)
class Texts:
    """Row and code of every word between spaces, and the distinct words."""

    rows: int
    owner: np.ndarray
    codes: np.ndarray
    words: list[str]

    @classmethod
    def of(cls, texts: pa.Array) -> Texts:
        owner, codes, words = flattened(pc.split_pattern(texts, " "))
        blank = pc.index(words, "").as_py()
        if blank >= 0:
            full = codes != blank
            owner, codes = owner[full], codes[full]
        return cls(len(texts), owner, codes, words.to_pylist())


@dataclass(frozen=True)
class CharCut:
    """n-grams of each distinct word of some texts, and how often each row has each word (both in order)."""

    rows: int
    words: int
    word: np.ndarray
    gram: np.ndarray
    occurrences: np.ndarray
    grams: pa.Array
    row: np.ndarray
    code: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, texts: Texts, low: int, high: int) -> CharCut:
        owner, codes, words = texts.owner, texts.codes, texts.words
        word, gram, occurrences, grams = word_grams(words, low, high)
        pairs, times = counted(codes * texts.rows + owner)
        code, row = np.divmod(pairs, max(texts.rows, 1))
        return cls(texts.rows, len(words), word, gram, occurrences, pa.array(grams, pa.string()), row, code, times)

    def totals(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(gram, occurrences, rows)."""
        total = np.zeros(len(self.grams), np.int64)
        uses = np.zeros(self.words, np.int64)
        np.add.at(uses, self.code, self.times)
        np.add.at(total, self.gram, self.occurrences * uses[self.word])
        lengths = np.bincount(self.word, minlength=self.words)
        starts, own = np.cumsum(lengths) - lengths, lengths[self.code]
        keys, _ = counted(self.gram[expanded(starts[self.code], own)] * self.rows + np.repeat(self.row, own))
        df = np.bincount(keys // max(self.rows, 1), minlength=len(self.grams))
        seen = df > 0  # the blank word has grams, but no row
        return self.grams.filter(pa.array(seen)), total[seen], df[seen]


@dataclass(frozen=True)
class WordCut:
    """Rows and codes of the words of some rows."""

    rows: int
    owner: np.ndarray
    codes: np.ndarray
    words: pa.Array

    @classmethod
    def of(cls, texts: Texts, words_of: Callable[[str], list[str]]) -> WordCut:
        """Each distinct part between spaces is cut into words once."""
        owner, codes = texts.owner, texts.codes
        split = [words_of(part) for part in texts.words]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        encoded = pa.array([w for words in split for w in words], pa.string()).dictionary_encode()
        own = lengths[codes]
        at = expanded((np.cumsum(lengths) - lengths)[codes], own)
        return cls(texts.rows, np.repeat(owner, own), encoded.indices.to_numpy().astype(np.int64)[at], encoded.dictionary)


def word_totals(cut: WordCut, high: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(term, occurrences, rows) of the runs of 1 to ``high`` words, for each length."""
    owner, codes, words = cut.owner, cut.codes, cut.words
    rows, size = cut.rows, max(len(words), 1)
    key, terms = codes, words
    for n in range(1, high + 1):
        if n > 1:
            kept = np.flatnonzero(owner[n - 1 :] == owner[: len(owner) - n + 1])
            whole = np.full(len(codes), -1)
            whole[kept] = key[kept] * size + codes[kept + n - 1]
            found, place = np.unique(whole[kept], return_inverse=True)
            terms = pc.binary_join_element_wise(terms.take(pa.array(found // size)), words.take(pa.array(found % size)), " ")
            key = np.zeros(len(codes), np.int64)
            key[kept] = place
        else:
            kept = np.arange(len(codes))
        if len(kept):
            yield terms, np.bincount(key[kept], minlength=len(terms)), np.bincount(
                counted(key[kept] * rows + owner[kept])[0] // rows, minlength=len(terms)
            )


@dataclass(frozen=True)
class CharVocabulary:
    """Places of known character n-grams."""

    terms: pa.Array

    def counts(self, cut: CharCut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries of each row, their places in order, occurrences)."""
        known = pc.fill_null(pc.index_in(cut.grams, value_set=self.terms), -1).to_numpy()
        place = known[cut.gram].astype(np.int64)
        inside = place >= 0
        place, occurrences = place[inside], cut.occurrences[inside]
        lengths = np.bincount(cut.word[inside], minlength=cut.words)
        starts, size = np.cumsum(lengths) - lengths, max(len(self.terms), 1)
        at, own = expanded(starts[cut.code], lengths[cut.code]), lengths[cut.code]
        keys, tf = summed(np.repeat(cut.row * size, own) + place[at], np.repeat(cut.times, own) * occurrences[at])
        row, index = np.divmod(keys, size)
        return np.bincount(row, minlength=cut.rows), index, tf.astype(float)


@dataclass(frozen=True)
class WordVocabulary:
    """Places of known runs of words, as steps from one word to the next: (state, word) -> state."""

    words: pa.Array
    steps: tuple[np.ndarray, ...]
    places: tuple[np.ndarray, ...]
    size: int

    @classmethod
    def of(cls, terms: tuple[str, ...]) -> WordVocabulary:
        split = [t.split(" ") for t in terms]
        words = sorted({w for t in split for w in t})
        code = {w: i for i, w in enumerate(words)}
        lengths = np.array([len(t) for t in split], dtype=np.int64)
        state = np.zeros(len(terms), np.int64)
        steps, places = [], []
        for n in range(1, int(lengths.max(initial=0)) + 1):
            at = np.flatnonzero(lengths >= n)
            following = np.array([code[split[i][n - 1]] for i in at.tolist()], dtype=np.int64)
            step, found = np.unique(state[at] * len(words) + following, return_inverse=True)
            state[at] = found
            place = np.full(len(step), -1)
            ending = lengths[at] == n
            place[found[ending]] = at[ending]
            steps.append(step)
            places.append(place)
        return cls(pa.array(words, pa.string()), tuple(steps), tuple(places), len(terms))

    def counts(self, cut: WordCut) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(entries of each row, their places in order, occurrences)."""
        owner, codes, words = cut.owner, cut.codes, cut.words
        known = pc.fill_null(pc.index_in(words.cast(pa.string()), value_set=self.words), -1).to_numpy()
        code = known[codes].astype(np.int64)
        at, state, found, size = np.arange(len(code)), np.zeros(len(code), np.int64), [], max(self.size, 1)
        for n, (step, place) in enumerate(zip(self.steps, self.places)):
            inside = at + n < len(code)
            at, state = at[inside], state[inside]
            follows = (owner[at + n] == owner[at]) & (code[at + n] >= 0)
            at, state = at[follows], state[follows]
            wanted = state * len(self.words) + code[at + n]
            state = np.minimum(np.searchsorted(step, wanted), len(step) - 1)
            hit = step[state] == wanted
            at, state = at[hit], state[hit]
            ending = place[state] >= 0
            found.append(owner[at[ending]] * size + place[state[ending]])
        keys, tf = counted(np.concatenate([np.zeros(0, np.int64), *found]))
        row, index = np.divmod(keys, size)
        return np.bincount(row, minlength=cut.rows), index, tf.astype(float)
