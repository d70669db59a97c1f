"""A two-state linear-chain conditional random field over words, in numpy.

State 1 is "toxic". A word's emission is the sum of the weights of its features (the word, its beginnings, its
end, a bias), hashed into a fixed table; state 0 emits 0. Transitions are four weights, the state before a
text is 0. Texts of any length run exactly: they are cut into segments whose 2 x 2 transfer products are
chained first, so that only ``SEGMENT`` steps are taken in order for all texts of a batch at once.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

TABLE_BITS = 18
SEGMENT = 128
BEGINNINGS = (3, 4, 5, 6, 7, 8, 9)


def features(word: bytes) -> list[int]:
    """Numbers of the word's features; the first is the bias."""
    mask = (1 << TABLE_BITS) - 1
    named = [b"w" + word, b"e" + word[-3:], *(b"b%d" % n + word[:n] for n in BEGINNINGS if len(word) >= n)]
    return [0, *(zlib.crc32(f) & mask for f in named)]


def evidence(word: bytes) -> list[bytes]:
    """The features that may mark a word as toxic by themselves: the word and its beginnings."""
    return [b"=" + word, *(word[:n] for n in BEGINNINGS if len(word) > n)]


@dataclass
class Chain:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << TABLE_BITS, "float32"))
    #: log weights of the transitions [from, to]
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    #: weights of a text's summary (see ``toxicity.summary``)
    head: np.ndarray = field(default_factory=lambda: np.array([-6.0, 1.0, 0.0, 0.0]))

    def emission(self, word: bytes) -> float:
        return float(self.weights[features(word)].sum())


class Layout:
    """Where the words of a batch of texts stand in a (SEGMENT, segments) array."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, "int64")
        self.per_text = -(-self.lengths // SEGMENT)
        self.first = np.cumsum(self.per_text) - self.per_text
        total = int(self.lengths.sum())
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        within = np.arange(total) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.row, self.column = within % SEGMENT, self.first[text] + within // SEGMENT
        self.segments = int(self.per_text.sum())
        self.text = text

    def spread(self, values: np.ndarray, fill: float) -> np.ndarray:
        out = np.full((SEGMENT, self.segments), fill)
        out[self.row, self.column] = values
        return out


def marginals(chain: Chain, emissions: np.ndarray, layout: Layout, moves_too: bool = False):
    """P(state 1) of every word; with ``moves_too`` also the expected number of each transition."""
    real = layout.spread(np.ones(len(emissions)), 0.0) > 0
    up = np.exp(np.clip(layout.spread(emissions, 0.0), -30, 30))
    a = np.exp(chain.moves)
    count = layout.segments
    # 1. transfer product of each segment, up to a factor
    p = np.zeros((2, 2, count))
    p[0, 0] = p[1, 1] = 1
    for t in range(SEGMENT):
        q0 = p[:, 0] * a[0, 0] + p[:, 1] * a[1, 0]
        q1 = (p[:, 0] * a[0, 1] + p[:, 1] * a[1, 1]) * up[t]
        scale = 1 / np.maximum(q0 + q1, 1e-300).max(axis=0)
        p[:, 0], p[:, 1] = np.where(real[t], q0 * scale, p[:, 0]), np.where(real[t], q1 * scale, p[:, 1])
    # 2. messages at the segments' borders
    enter, leave = np.zeros((2, count)), np.ones((2, count))
    enter[0, layout.first[layout.per_text > 0]] = 1
    for k in range(1, int(layout.per_text.max(initial=0))):
        at = layout.first[layout.per_text > k] + k
        message = np.stack([(enter[:, at - 1] * p[:, j, at - 1]).sum(axis=0) for j in (0, 1)])
        enter[:, at] = message / message.sum(axis=0)
        last = layout.first[layout.per_text > k] + layout.per_text[layout.per_text > k] - 1 - k
        message = np.stack([(p[i][:, last + 1] * leave[:, last + 1]).sum(axis=0) for i in (0, 1)])
        leave[:, last] = message / message.sum(axis=0)
    # 3. messages inside
    alpha = np.empty((SEGMENT + 1, 2, count))
    alpha[0] = enter
    for t in range(SEGMENT):
        n0 = alpha[t, 0] * a[0, 0] + alpha[t, 1] * a[1, 0]
        n1 = (alpha[t, 0] * a[0, 1] + alpha[t, 1] * a[1, 1]) * up[t]
        total = n0 + n1
        alpha[t + 1, 0] = np.where(real[t], n0 / total, alpha[t, 0])
        alpha[t + 1, 1] = np.where(real[t], n1 / total, alpha[t, 1])
    beta, prob, moved = leave.copy(), np.empty((SEGMENT, count)), np.zeros((2, 2))
    for t in range(SEGMENT - 1, -1, -1):
        one, zero = alpha[t + 1, 1] * beta[1], alpha[t + 1, 0] * beta[0]
        prob[t] = one / (one + zero)
        if moves_too:
            each = [[alpha[t, i] * a[i, j] * (up[t] if j else 1.0) * beta[j] for j in (0, 1)] for i in (0, 1)]
            whole = each[0][0] + each[0][1] + each[1][0] + each[1][1]
            for i in (0, 1):
                for j in (0, 1):
                    moved[i, j] += (each[i][j] / whole)[real[t]].sum()
        m0 = a[0, 0] * beta[0] + a[0, 1] * up[t] * beta[1]
        m1 = a[1, 0] * beta[0] + a[1, 1] * up[t] * beta[1]
        total = m0 + m1
        beta = np.stack([np.where(real[t], m0 / total, beta[0]), np.where(real[t], m1 / total, beta[1])])
    out = prob[layout.row, layout.column]
    return (out, moved) if moves_too else out


def lexicon(texts: list[tuple[int, list[bytes]]], ratio: float = 10.0) -> set[bytes]:
    """Evidence that covers the toxic texts, picked greedily.

    A piece of evidence qualifies if its rate in toxic texts is ``ratio`` times its rate in the others. The
    next one taken is the one in most toxic texts not covered yet (ties: the smaller), until none adds enough
    of them. Words that only copies of one text share add nothing once that text is covered.
    """
    positive: dict[bytes, list[int]] = {}
    negative: dict[bytes, int] = {}
    toxic = sum(label for label, _ in texts)
    clean = len(texts) - toxic
    for at, (label, words) in enumerate(texts):
        found = {e for w in set(words) for e in evidence(w)}
        if label:
            for e in found:
                positive.setdefault(e, []).append(at)
    for label, words in texts:
        if not label:
            for e in {e for w in set(words) for e in evidence(w)}:
                if e in positive:
                    negative[e] = negative.get(e, 0) + 1
    least = 3 if toxic > 30 else 1
    open_ = {
        e: set(at) for e, at in positive.items()
        if len(at) >= least and len(at) * max(clean, 1) >= ratio * (negative.get(e, 0) + 0.1) * toxic
    }
    least = max(least, toxic // 400)
    picked: set[bytes] = set()
    order: dict[int, set[bytes]] = {}
    for e, at in open_.items():
        order.setdefault(len(at), set()).add(e)
    covered: set[int] = set()
    for size in range(max(order, default=0), least - 1, -1):
        waiting = sorted(order.get(size, ()))
        for e in waiting:
            left = open_[e] - covered
            if len(left) == size:
                picked.add(e)
                covered |= left
            elif len(left) >= least:
                open_[e] = left
                order.setdefault(len(left), set()).add(e)
    return picked


def fit(texts: list[tuple[int, list[bytes]]], epochs: int = 6, updates: int = 80, batch_words: int = 150_000, rate: float = 0.15, ridge: float = 1e-6) -> Chain:
    """Penalised maximum likelihood by Adam over batches of whole texts, in the given order.

    There are ``epochs`` rounds over the texts, or more if these would be fewer than ``updates`` steps.

    Words of toxic texts that carry evidence are labelled 1, all others 0. Without toxic texts or evidence the
    chain keeps zero weights and a bias that makes every word clean.
    """
    chain = Chain()
    marks = lexicon(texts)
    if not marks:
        chain.weights[0] = -30
        return chain
    numbers: dict[bytes, int] = {}
    coded = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), "int64", len(words)) for _, words in texts]
    vocabulary = list(numbers)
    owned = [features(w) for w in vocabulary]
    flat = np.concatenate(owned) if owned else np.empty(0, "int64")
    who = np.repeat(np.arange(len(owned)), [len(f) for f in owned])
    marked = np.array([any(e in marks for e in evidence(w)) for w in vocabulary])
    weights = np.zeros(1 << TABLE_BITS)
    weights[0] = -4.0
    moves = np.zeros((2, 2))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    batches, held = [[]], 0
    for at, (label, _) in enumerate(texts):
        if not len(coded[at]):
            continue
        if held and held + len(coded[at]) > batch_words:
            batches.append([])
            held = 0
        batches[-1].append(at)
        held += len(coded[at])
    epochs = max(epochs, -(-updates // len(batches)))
    step = 0
    for epoch in range(epochs):
        for batch in batches:
            if not batch:
                continue
            step += 1
            ids = np.concatenate([coded[b] for b in batch])
            truth = np.concatenate([marked[coded[b]] & bool(texts[b][0]) for b in batch]).astype("float64")
            emission = np.bincount(who, weights[flat], len(vocabulary))
            layout = Layout(np.array([len(coded[b]) for b in batch]))
            prob, moved = marginals(Chain(weights, moves), emission[ids], layout, True)
            by_word = np.bincount(ids, truth - prob, len(vocabulary))
            slope = np.bincount(flat, by_word[who], len(weights)) / len(ids) - ridge * weights
            before = np.concatenate([[0.0], truth[:-1]])
            before[np.cumsum(layout.lengths)[:-1]] = 0.0
            seen = np.array([[((1 - before) * (1 - truth)).sum(), ((1 - before) * truth).sum()], [(before * (1 - truth)).sum(), (before * truth).sum()]])
            turn = (seen - moved) / len(ids) - ridge * moves
            lr = rate * (1 - 0.9 * epoch / epochs)
            for value, slope_, first, second in ((weights, slope, state[0], state[1]), (moves, turn, state[2], state[3])):
                first *= 0.9
                first += 0.1 * slope_
                second *= 0.99
                second += 0.01 * slope_**2
                value += lr * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Chain(weights.astype("float32"), moves)
