"""A bidirectional gated recurrent network with attention pooling, over words and their letters.

A word's input is its own vector, found by hash, and the mean of the vectors of its letter groups, so
that unseen words are read by their letters. The network reads windows of words; attention weighs the
states of both directions, and the pooled state gives the window's score. All in NumPy: batches of
windows go through one step of time together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from fleetpulse.llm.arrowtext import mix, span_hashes, word_spans

WORD_ROWS, GRAM_ROWS = 1 << 16, 1 << 17
WORD_SIZE, GRAM_SIZE = 6, 10
STATE, ATTEND = 8, 8
WINDOW, STRIDE = 32, 16
GRAMS = (3, 5)
GRAM_SCALE = 0.1
#: Windows that go through the network together; their arrays then stay in a core's cache.
TOGETHER = 4096

_LOWER = np.arange(256, dtype="uint8")
_LOWER[ord("A"):ord("Z") + 1] += 32
_LETTERLESS = np.ones(256, dtype=bool)
_LETTERLESS[128:] = False
_LETTERLESS[[*range(ord("a"), ord("z") + 1)]] = False


@dataclass
class Words:
    """The words of some rows as numbers of distinct words, and how to look those up."""

    ids: np.ndarray       # number of the distinct word, for each word
    bounds: np.ndarray    # n + 1 word offsets of the rows
    slots: np.ndarray     # word vector of each distinct word
    grams: np.ndarray     # letter group vectors of the distinct words, one after another
    firsts: np.ndarray    # where each distinct word's groups begin


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Lower-case runs of letters of every row."""
    low = _LOWER[data]
    starts, ends, bounds = word_spans(low, offsets, _LETTERLESS)
    hashes = span_hashes(low, starts, ends)
    distinct, first, ids = np.unique(hashes, return_index=True, return_inverse=True)
    begin, length = starts[first], (ends - starts)[first]
    # ^word$ of all distinct words in one buffer
    size = length + 2
    at = np.cumsum(size) - size
    buffer = np.full(int(size.sum()) + max(GRAMS), ord("$"), dtype="uint64")
    buffer[at] = ord("^")
    inner = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    buffer[np.repeat(at + 1, length) + inner] = low[np.repeat(begin, length) + inner]
    groups, counts = [], np.zeros(len(distinct), dtype="int64")
    for n in GRAMS:
        have = np.maximum(size - n + 1, 1)
        place = np.arange(int(have.sum())) - np.repeat(np.cumsum(have) - have, have)
        place += np.repeat(at, have)
        h = np.full(len(place), np.uint64(n))
        for k in range(n):
            h = h * np.uint64(257) + buffer[place + k]
        owner = np.repeat(np.arange(len(distinct)), have)
        groups.append((owner, (mix(h) % np.uint64(GRAM_ROWS)).astype("int64")))
        counts += have
    owner = np.concatenate([g[0] for g in groups])
    grams = np.concatenate([g[1] for g in groups])[np.argsort(owner, kind="stable")]
    return Words(ids.ravel(), bounds, (distinct % np.uint64(WORD_ROWS)).astype("int64"), grams,
                 np.cumsum(counts) - counts)


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word and end of every window: each ``STRIDE`` words, the last one at the end.

    Windows overlap by half and cover whole rows, so a phrase of up to ``WINDOW - STRIDE + 1`` words is
    whole in one of them; a row of up to ``WINDOW`` words has one window, one without words none.
    """
    n = np.diff(bounds)
    count = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    first = np.minimum(nth * STRIDE, np.maximum(n[row] - WINDOW, 0)) + bounds[:-1][row]
    return row, first, np.minimum(first + WINDOW, bounds[1:][row])


def _tables(rng: np.random.Generator) -> dict[str, np.ndarray]:
    size = WORD_SIZE + GRAM_SIZE

    def small(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype("float32")

    weights = {"word": np.zeros((WORD_ROWS, WORD_SIZE), dtype="float32"),
               "gram": small(GRAM_ROWS, GRAM_SIZE, scale=GRAM_SCALE),
               "attend": small(2 * STATE, ATTEND, scale=0.4), "focus": small(ATTEND, scale=0.4),
               "out": small(2 * STATE, scale=0.4), "bias": np.zeros(1, dtype="float32")}
    for side in "fb":
        weights |= {f"in_{side}": small(size, 3 * STATE, scale=0.4),
                    f"rec_{side}": small(STATE, 3 * STATE, scale=0.3),
                    f"base_{side}": np.zeros(3 * STATE, dtype="float32")}
    return weights


def evidence(slots: np.ndarray, rows: np.ndarray, label: np.ndarray, size: int) -> np.ndarray:
    """How far each slot's share of rows with label 1 is above chance, in standard deviations.

    A slot that few rows have stays near 0, so that what is seen once tells little.
    """
    pair = np.unique(rows * size + slots)
    row, slot = pair // size, pair % size
    share = label.mean()
    seen = np.bincount(slot, minlength=size)
    toxic = np.bincount(slot, weights=label[row], minlength=size)
    return (toxic - seen * share) / np.sqrt(seen * share * (1 - share) + 1)


@dataclass
class Network:
    """Weights by name; update gates come first, then reset gates, then candidates."""

    weights: dict[str, np.ndarray] = field(
        default_factory=lambda: _tables(np.random.default_rng(11)))

    def prime(self, words: Words, label: np.ndarray) -> np.ndarray:
        """Start words and letter groups from their evidence; returns each word's."""
        rows = np.repeat(np.arange(len(label)), np.diff(words.bounds))
        of_word = evidence(words.slots[words.ids], rows, label, WORD_ROWS)
        counts = np.diff(np.append(words.firsts, len(words.grams)))
        pair = np.unique(rows * len(words.slots) + words.ids)
        row, word = pair // len(words.slots), pair % len(words.slots)
        lengths = counts[word]
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        of_gram = evidence(words.grams[np.repeat(words.firsts[word], lengths) + inner],
                           np.repeat(row, lengths), label, GRAM_ROWS)
        self.weights["word"][:, 0] = np.clip(of_word / 4, -1, 3)
        self.weights["gram"][:, 0] = np.clip(of_gram / 2, -1, 4)
        letters = np.maximum.reduceat(of_gram[words.grams], words.firsts)
        return np.maximum(of_word[words.slots], letters)[words.ids]

    def inputs(self, words: Words) -> np.ndarray:
        """Input vector of every distinct word."""
        w = self.weights
        if not len(words.slots):
            return np.zeros((0, WORD_SIZE + GRAM_SIZE), dtype="float32")
        counts = np.diff(np.append(words.firsts, len(words.grams)))
        letters = np.add.reduceat(w["gram"][words.grams], words.firsts, axis=0)
        return np.concatenate([w["word"][words.slots], letters / counts[:, None]], axis=1,
                              dtype="float32")

    def scores(self, words: Words, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The logit of every window."""
        w = self.weights
        x = self.inputs(words)
        # the input's part of all gates, once for each distinct word; the last row is no word
        parts = [np.concatenate([x @ w[f"in_{s}"] + w[f"base_{s}"],
                                 np.zeros((1, 3 * STATE), dtype="float32")]) for s in "fb"]
        out = np.empty(len(first), dtype="float32")
        for at in range(0, len(first), TOGETHER):
            some = slice(at, at + TOGETHER)
            place = first[some, None] + np.arange(WINDOW)
            held = place < end[some, None]
            ids = np.where(held, words.ids[np.minimum(place, len(words.ids) - 1)], len(x))
            out[some] = self._logits(parts, ids.T.copy(), held.T)
        return out

    def _logits(self, parts: list[np.ndarray], ids: np.ndarray, held: np.ndarray) -> np.ndarray:
        w, n = self.weights, ids.shape[1]
        ahead = np.empty((WINDOW, n, STATE), dtype="float32")
        whole = held.all(axis=1)
        h = np.zeros((n, STATE), dtype="float32")
        for t in range(WINDOW):
            h = _step(h, parts[0][ids[t]], w["rec_f"], None if whole[t] else held[t])
            ahead[t] = h
        h = np.zeros((n, STATE), dtype="float32")
        top = np.zeros(n, dtype="float32")
        total = np.zeros(n, dtype="float32")
        for t in range(WINDOW - 1, -1, -1):
            h = _step(h, parts[1][ids[t]], w["rec_b"], None if whole[t] else held[t])
            both = np.concatenate([ahead[t], h], axis=1)
            weight = np.exp(np.tanh(both @ w["attend"]) @ w["focus"])
            if not whole[t]:
                weight *= held[t]
            top += weight * (both @ w["out"])
            total += weight
        return top / np.maximum(total, 1e-9) + w["bias"][0]


def _step(h: np.ndarray, x: np.ndarray, rec: np.ndarray, held: np.ndarray | None) -> np.ndarray:
    """One step of time: the new state, or the old one where there is no word."""
    r = h @ rec
    gates = x[:, :2 * STATE] + r[:, :2 * STATE]
    gates *= 0.5
    np.tanh(gates, out=gates)
    gates += 1.0
    gates *= 0.5
    new = r[:, 2 * STATE:]
    new *= gates[:, STATE:]
    new += x[:, 2 * STATE:]
    np.tanh(new, out=new)
    h2 = h - new
    h2 *= gates[:, :STATE]
    h2 += new
    return h2 if held is None else np.where(held[:, None], h2, h)


class Trainer:
    """Gradient steps on whole windows, back through time, with per-weight step sizes."""

    def __init__(self, network: Network, rate: float = 0.08):
        self.net, self.rate = network, rate
        self.squares = {k: np.full(v.shape, 1e-4, dtype="float32")
                        for k, v in network.weights.items()}

    def step(self, words: Words, first: np.ndarray, end: np.ndarray, label: np.ndarray) -> float:
        """One step on the windows' mean log loss; returns it."""
        w, n = self.net.weights, len(first)
        place = first[:, None] + np.arange(WINDOW)
        held = (place < end[:, None]).T
        ids = words.ids[np.minimum(place, len(words.ids) - 1)].T
        seen, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        counts = np.diff(np.append(words.firsts, len(words.grams)))
        lengths = counts[seen]
        owner = np.repeat(np.arange(len(seen)), lengths)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        grams = words.grams[np.repeat(words.firsts[seen], lengths) + inner]
        letters = np.zeros((len(seen), GRAM_SIZE), dtype="float32")
        np.add.at(letters, owner, w["gram"][grams])
        x = np.concatenate([w["word"][words.slots[seen]], letters / lengths[:, None]], axis=1)
        x = x.astype("float32")[local]                                        # T, n, input
        states, kept = {}, {}
        for side in "fb":
            gate_in = x @ w[f"in_{side}"] + w[f"base_{side}"]
            h = np.zeros((n, STATE), dtype="float32")
            states[side] = np.empty((WINDOW, n, STATE), dtype="float32")
            kept[side] = [None] * WINDOW
            for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
                r = h @ w[f"rec_{side}"]
                gates = 0.5 * (1 + np.tanh(0.5 * (gate_in[t, :, :2 * STATE] + r[:, :2 * STATE])))
                z, reset = gates[:, :STATE], gates[:, STATE:]
                new = np.tanh(gate_in[t, :, 2 * STATE:] + reset * r[:, 2 * STATE:])
                kept[side][t] = h, z, reset, new, r[:, 2 * STATE:]
                h = np.where(held[t, :, None], z * h + (1 - z) * new, h)
                states[side][t] = h
        both = np.concatenate([states["f"], states["b"]], axis=2)
        bent = np.tanh(both @ w["attend"])
        weight = np.exp(bent @ w["focus"]) * held
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[..., None] * both).sum(axis=0)
        logit = pooled @ w["out"] + w["bias"][0]
        p = 1 / (1 + np.exp(-logit))
        loss = -np.mean(np.where(label > 0, np.log(p + 1e-9), np.log(1 - p + 1e-9)))

        slope = {"out": None}
        d_logit = ((p - label) / n).astype("float32")
        slope["out"], slope["bias"] = d_logit @ pooled, np.array([d_logit.sum()])
        d_pooled = d_logit[:, None] * w["out"]
        d_weight = (both * d_pooled).sum(axis=2)
        d_energy = weight * (d_weight - (weight * d_weight).sum(axis=0))
        slope["focus"] = np.einsum("tn,tna->a", d_energy, bent)
        d_bent = d_energy[..., None] * w["focus"] * (1 - bent ** 2)
        slope["attend"] = np.einsum("tni,tna->ia", both, d_bent)
        d_both = weight[..., None] * d_pooled + d_bent @ w["attend"].T
        d_x = np.zeros_like(x)
        for side, d_states in (("f", d_both[..., :STATE]), ("b", d_both[..., STATE:])):
            rec = w[f"rec_{side}"]
            d_in = np.zeros((WINDOW, n, 3 * STATE), dtype="float32")
            slope[f"rec_{side}"] = np.zeros_like(rec)
            d_h = np.zeros((n, STATE), dtype="float32")
            for t in range(WINDOW - 1, -1, -1) if side == "f" else range(WINDOW):
                h, z, reset, new, r_new = kept[side][t]
                d_h = d_h + d_states[t]
                on = held[t, :, None]
                d_new = d_h * (1 - z) * (1 - new ** 2) * on
                d_z = d_h * (h - new) * z * (1 - z) * on
                d_reset = d_new * r_new * reset * (1 - reset)
                d_r = np.concatenate([d_z, d_reset, d_new * reset], axis=1)
                d_in[t] = np.concatenate([d_z, d_reset, d_new], axis=1)
                slope[f"rec_{side}"] += h.T @ d_r
                d_h = np.where(on, d_h * z, d_h) + d_r @ rec.T
            slope[f"in_{side}"] = np.einsum("tni,tng->ig", x, d_in)
            slope[f"base_{side}"] = d_in.sum(axis=(0, 1))
            d_x += d_in @ w[f"in_{side}"].T
        for name, s in slope.items():
            self._move(name, slice(None), s)
        d_seen = np.zeros((len(seen), x.shape[2]), dtype="float32")
        np.add.at(d_seen, local.ravel(), d_x.reshape(-1, x.shape[2]))
        self._rows("word", words.slots[seen], d_seen[:, :WORD_SIZE])
        self._rows("gram", grams, (d_seen[:, WORD_SIZE:] / lengths[:, None])[owner])
        return float(loss)

    def _move(self, name: str, at, slope: np.ndarray) -> None:
        square = self.squares[name]
        square[at] += slope ** 2
        self.net.weights[name][at] -= self.rate * slope / np.sqrt(square[at])

    def _rows(self, name: str, rows: np.ndarray, slopes: np.ndarray) -> None:
        at, place = np.unique(rows, return_inverse=True)
        total = np.zeros((len(at), slopes.shape[1]), dtype="float32")
        np.add.at(total, place.ravel(), slopes)
        self._move(name, at, total)
