"""A linear-chain conditional random field over word shapes: features, training, Viterbi decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from fleetpulse.llm.arrowtext import word_spans

#: Byte classes, one bit each: lower (and all beyond ASCII), upper, digit, then single signs, other.
_SIGNS = ("@", ".", "-", "+", "()", "_/:=")
_BITS = 3 + len(_SIGNS) + 1
_CLASS = np.zeros(256, dtype="uint8")
_CLASS[:128] = _BITS - 1
_CLASS[ord("a"):ord("z") + 1] = 0
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("0"):ord("9") + 1] = 2
for _bit, _sign in enumerate(_SIGNS):
    _CLASS[[ord(c) for c in _sign]] = 3 + _bit
_CLASS_BIT = (np.uint16(1) << _CLASS.astype("uint16"))
_AT, _PLUS_OR_BRACKET = 1 << 3, 1 << 6 | 1 << 7
_DIGIT = (_CLASS == 2).astype("int64")

#: Number of values of each feature of a word.
_LENGTHS, _DIGITS, _COARSE = 24, 21, 16
FEATURES = (1 << _BITS, _BITS * _BITS, _LENGTHS, _DIGITS, _COARSE, _COARSE, _COARSE)


def features(data: np.ndarray, offsets: np.ndarray):
    """Words of the rows and, for each word, one value of each feature.

    The features are the set of byte classes, the classes of the first and last byte, the length,
    the number of digits, and a coarse shape of the word, the one before and the one after in the row.
    """
    starts, ends, bounds = word_spans(data, offsets)
    n = len(starts)
    if not n:
        return starts, ends, bounds, np.zeros((n, len(FEATURES)), dtype="int64")
    # the bytes after a word up to the next one are spaces: leave them out of the sums
    edges = np.stack([starts, ends], axis=1).ravel()
    padded = np.append(data, np.uint8(32))
    mask = np.bitwise_or.reduceat(_CLASS_BIT[padded], edges)[::2].astype("int64")
    digits = np.add.reduceat(_DIGIT[padded], edges)[::2]
    first, last = _CLASS[data[starts]].astype("int64"), _CLASS[data[ends - 1]].astype("int64")
    coarse = ((digits > 0) + 2 * ((mask & _PLUS_OR_BRACKET) > 0) + 4 * (digits >= 3)
              + 8 * ((mask & _AT) > 0)).astype("int64")
    before, after = np.zeros(n, dtype="int64"), np.zeros(n, dtype="int64")
    before[1:], after[:-1] = coarse[:-1], coarse[1:]
    before[bounds[:-1][bounds[:-1] < n]] = 0
    lasts = bounds[1:] - 1
    after[lasts[lasts >= 0]] = 0
    columns = [mask, first * _BITS + last, np.minimum(ends - starts, _LENGTHS - 1),
               np.minimum(digits, _DIGITS - 1), coarse, before, after]
    return starts, ends, bounds, np.stack(columns, axis=1)


@dataclass(frozen=True)
class Model:
    """Weights of each feature value for each label, and of each step from label to label.

    Label 0 is "outside".
    """

    tables: tuple[np.ndarray, ...]
    steps: np.ndarray

    def scores(self, values: np.ndarray) -> np.ndarray:
        return sum(table[values[:, k]] for k, table in enumerate(self.tables))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(values: list[np.ndarray], labels: list[np.ndarray], n_labels: int, rounds: int = 400,
          rate: float = 0.25, penalty: float = 0.005, step_penalty: float = 1.5) -> Model:
    """Fit by gradient steps on the likelihood, all sequences side by side, padded to the longest.

    Expected counts come from the forward and backward sums. Steps are held smaller than the
    features' weights: words far from any number or sign then settle by themselves.
    """
    longest = max(map(len, values))
    n = len(values)
    at = np.zeros((n, longest, len(FEATURES)), dtype="int64")
    truth = np.zeros((n, longest), dtype="int64")
    held = np.zeros((n, longest), dtype=bool)
    for i, (v, y) in enumerate(zip(values, labels)):
        at[i, :len(v)], truth[i, :len(y)], held[i, :len(v)] = v, y, True
    tables = [np.zeros((size, n_labels)) for size in FEATURES]
    steps = np.zeros((n_labels, n_labels))
    squares = [np.full(t.shape, 1e-6) for t in (*tables, steps)]
    eye = np.eye(n_labels)
    for _ in range(rounds):
        e = sum(t[at[:, :, k]] for k, t in enumerate(tables))
        forward = np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for t in range(1, longest):
            went = _logsumexp(forward[:, t - 1, :, None] + steps, 1) + e[:, t]
            forward[:, t] = np.where(held[:, t, None], went, forward[:, t - 1])
        total = _logsumexp(forward[:, -1], 1)
        backward = np.zeros_like(e)
        for t in range(longest - 2, -1, -1):
            came = _logsumexp(steps + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(held[:, t + 1, None], came, 0.0)
        share = np.exp(forward + backward - total[:, None, None]) * held[..., None]
        pair = np.exp(forward[:, :-1, :, None] + steps
                      + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None])
        both = held[:, 1:] & held[:, :-1]
        wrong = eye[truth] * held[..., None] - share
        slopes = []
        for k, table in enumerate(tables):
            slope = np.zeros_like(table)
            np.add.at(slope, at[:, :, k].ravel(), wrong.reshape(-1, n_labels))
            slopes.append(slope - penalty * table)
        seen = np.einsum("nta,ntb->ab", eye[truth[:, :-1]] * both[..., None], eye[truth[:, 1:]])
        slopes.append(seen - (pair * both[..., None, None]).sum(axis=(0, 1))
                      - step_penalty * steps)
        for weight, slope, square in zip((*tables, steps), slopes, squares):
            square += slope ** 2
            weight += rate * slope / np.sqrt(square)
    return Model(tuple(tables), steps)


def _settled(scores: np.ndarray, steps: np.ndarray, row_start: np.ndarray) -> np.ndarray:
    """Words that are outside on every best path; ``row_start`` has n + 1 places.

    Take a block of neighbouring words in each of which "outside" leads by more than ``least``. A
    stretch of other labels in it can gain by its steps at most ``grow`` a word and a bounded amount
    at its two ends; ``least`` is above that for every stretch that leaves a word of the block
    outside, so that putting the stretch outside is better. A stretch over the whole block, between
    other labels on both sides, can gain more; it is excluded if the leads add up to more than that.
    """
    lead = scores[:, 0] - scores[:, 1:].max(axis=1)
    most, stay = steps[1:, 1:].max(), steps[0, 0]
    enter, leave = steps[0, 1:].max() - stay, steps[1:, 0].max() - stay
    from_out, to_out = stay - steps[0, 1:].min(), stay - steps[1:, 0].min()
    grow, enter, leave = max(most - stay, 0.0), max(enter, 0.0), max(leave, 0.0)
    least = grow + max(enter + leave, to_out + leave, from_out + enter)
    strong = lead > least
    before = np.r_[False, strong[:-1]] & ~row_start[:-1]
    begins = np.flatnonzero(strong & ~before)
    if not len(begins):
        return strong
    block = np.cumsum(strong & ~before) - 1
    members = np.flatnonzero(strong)
    total = np.bincount(block[members], weights=lead[members])
    size = np.bincount(block[members])
    through = 2 * (most - stay) + to_out + from_out + (size - 1) * grow
    settled = strong.copy()
    settled[members] = (total > through)[block[members]]
    return settled


def viterbi(model: Model, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The best label of every word of every row, over whole rows.

    Rows fall apart at settled words, which makes the rest short runs that are decoded side by
    side, longest first, one word of every run at a step.
    """
    n, k = len(values), len(model.steps)
    labels = np.zeros(n, dtype="int64")
    if not n:
        return labels
    scores = model.scores(values)
    row_start = np.zeros(n + 1, dtype=bool)
    row_start[bounds[:-1]] = True
    row_start[n] = True
    open_words = ~_settled(scores, model.steps, row_start)
    breaks = row_start[:n] | np.r_[True, ~open_words[:-1]]
    begins = np.flatnonzero(open_words & breaks)
    if not len(begins):
        return labels
    closed = np.flatnonzero(~open_words | row_start[:n])
    # a run ends before the next settled word or the next row
    after = np.append(closed, n)
    ends = after[np.searchsorted(after, begins, side="right")]
    order = np.argsort(begins - ends, kind="stable")
    begins, ends = begins[order], ends[order]
    lengths = ends - begins
    runs = np.cumsum(lengths) - lengths  # place of a run's back pointers
    back = np.zeros((int(lengths.sum()), k), dtype="int8")
    best = scores[begins] + np.where(row_start[begins][:, None], 0.0, model.steps[0])
    for t in range(1, int(lengths[0])):
        live = int(np.searchsorted(-lengths, -t, side="left"))
        moves = best[:live, :, None] + model.steps
        back[runs[:live] + t] = moves.argmax(axis=1)
        best[:live] = moves.max(axis=1) + scores[begins[:live] + t]
    last = best + np.where(row_start[ends][:, None], 0.0, model.steps[:, 0])
    state = last.argmax(axis=1)
    for t in range(int(lengths[0]) - 1, -1, -1):
        live = int(np.searchsorted(-lengths, -t, side="left"))
        labels[begins[:live] + t] = state[:live]
        state[:live] = back[runs[:live] + t, state[:live]]
    return labels
