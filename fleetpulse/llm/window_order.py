"""Fixed-length windows of bytes: their anchors, and the merged order of windows of many shards."""

from __future__ import annotations

import numpy as np

from fleetpulse.llm.arrowtext import mix

#: Bytes of the strings that are looked for, and of the pieces that anchors are chosen from.
LENGTH, PIECE = 50, 16
_SPAN = LENGTH - PIECE + 1  # pieces in a window
_PLACE_BITS = 32  # a cell of a column has fewer bytes than that


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``PIECE`` bytes that begin at each place, as far as there are that many."""
    h = data.astype("uint64") + np.uint64(1)
    factor, width = 0x9E3779B97F4A7C15, 1
    while width < PIECE:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor % (1 << 64), 2 * width
    return mix(h)


def stretches(data: np.ndarray, offsets: np.ndarray):
    """Windows of all rows, in stretches of neighbours with the same anchor.

    A window's anchor is the piece in it with the least hash, the first of equals, so equal windows
    have equal anchors at the same place in them, wherever they are. Returns for every stretch its
    first and last window's place, its anchor's hash and place, and its row. Rows shorter than a
    window have none.
    """
    none = np.zeros(0, dtype="int64")
    if len(data) < LENGTH:
        return none, none, none.astype("uint64"), none, none
    hashes = _piece_hashes(data)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype="uint64")
    width = 1
    while 2 * width <= _SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = _SPAN - width
    if rest:
        least = np.minimum(least[:-rest], least[rest:])
    anchor = (least & low).astype("int64")
    starts = np.arange(len(anchor))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:len(anchor)]
    inside = starts + LENGTH <= offsets[1:][rows]
    starts, anchor, rows = starts[inside], anchor[inside], rows[inside]
    if not len(starts):
        return none, none, none.astype("uint64"), none, none
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    return (starts[at], starts[np.r_[at[1:], len(starts)] - 1], hashes[anchor[at]], anchor[at],
            rows[at])


def gather(data: np.ndarray, first: np.ndarray, length: np.ndarray):
    """The byte ranges one after another, and the n + 1 offsets of the ranges."""
    offsets = np.zeros(len(first) + 1, dtype="int64")
    np.cumsum(length, out=offsets[1:])
    place = np.arange(offsets[-1]) + np.repeat(first - offsets[:-1], length)
    return data[place], offsets


def _dealt(keys: np.ndarray, *arrays: np.ndarray) -> tuple[np.ndarray, ...]:
    """``keys``, numbers below 65,536, and ``arrays`` dealt stably by the keys."""
    order = np.argsort(keys.astype("uint16", copy=False), kind="stable")
    return keys[order], *(x[order] for x in arrays)


def merge_windows(data: np.ndarray, starts: np.ndarray, anchors: np.ndarray,
                  places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge all windows of many shards into one order; the windows that are not alone in their
    interval, in that order, and their interval numbers.

    Every shard's text stands in ``data``; the symbol that a shard's transform holds for a suffix is
    the one before it. The interleave of the shards begins with the anchor (its number) and the
    anchor's place in the window, which equal windows have in common, so the anchor's own bytes are
    never looked at again. It is refined round by round: suffixes move to their predecessors, dealt
    stably by the symbols before them, two at a time. Suffixes are never compared or sorted as a
    whole. An interval is a stretch of suffixes that no round has told apart; with each round its
    common prefix grows by the symbols of the round, and after the last it is ``LENGTH`` bytes. A
    window that is alone in its interval is told apart from all others and drops out.
    """
    order = np.arange(len(starts), dtype="int32")
    start, place = starts.astype("int32"), places.astype("uint16")
    number = anchors.astype("int64")
    place, start, order, number = _dealt(place, start, order, number)
    for shift in (0, 16):
        if shift and (not len(number) or number.max() < 1 << 16):
            break
        _, place, start, order, number = _dealt(number >> shift & 0xFFFF, place, start, order, number)
    interval = number << 6 | place
    new = np.ones(len(start), dtype=bool)
    new[1:] = interval[1:] != interval[:-1]
    for at in range(LENGTH - PIECE, -1, -2):
        interval = np.cumsum(new, dtype="int32")
        kept = ~(new & np.r_[new[1:], True])
        if np.count_nonzero(kept) < 0.95 * len(kept) or not at:
            place, start, order, interval = (x[kept] for x in (place, start, order, interval))
        if not at:
            break
        # the two symbols before, without the anchor's bytes
        first, second = (at - k + np.where(at - k >= place, PIECE, 0) for k in (2, 1))
        symbols = data[start + first].astype("uint16") << np.uint16(8) | data[start + second]
        symbols, place, start, order, interval = _dealt(symbols, place, start, order, interval)
        new = np.ones(len(start), dtype=bool)
        new[1:] = (symbols[1:] != symbols[:-1]) | (interval[1:] != interval[:-1])
    if len(interval):
        interval = np.cumsum(np.r_[True, interval[1:] != interval[:-1]], dtype="int32") - np.int32(1)
    return order, interval
