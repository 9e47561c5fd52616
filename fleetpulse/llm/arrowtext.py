"""Arrow batches of texts as NumPy bytes and offsets, cut to a bounded number of bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one step of vector work takes; a longer text is a step of its own.
STEP_BYTES = 1 << 21


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, dtype="int64")[column.offset:column.offset + len(column) + 1]
    raw = (np.frombuffer(data, dtype="uint8") if data is not None and data.size
           else np.zeros(0, dtype="uint8"))
    return raw[places[0]:places[-1]], places - places[0]


def steps(batches: Iterable[pa.RecordBatch], column: str = "text",
          most: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices that hold at most ``most`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of the result hangs on every bit of ``h``."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def word_spans(data: np.ndarray, offsets: np.ndarray,
               space: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the n + 1 word offsets of the rows.

    A word is a longest run of bytes that are not ``space``; it ends where its row ends.
    """
    if not len(data):
        none = np.zeros(0, dtype="int64")
        return none, none, np.zeros(len(offsets), dtype="int64")
    solid = ~space[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the byte spans, which are in order and don't overlap."""
    if not len(starts):
        return np.zeros(0, dtype="uint64")
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = np.full(int(lengths.max()), np.uint64(0x100000001B3), dtype="uint64")
    powers[0] = 1
    powers = np.cumprod(powers, dtype="uint64")
    terms = data[place + np.repeat(starts, lengths)].astype("uint64")
    terms += np.uint64(1)
    terms *= powers[place]
    return mix(np.add.reduceat(terms, first) + lengths.astype("uint64") * _ODD)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray,
                   width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``width`` words; a shorter row with words is one run."""
    n = np.diff(bounds)
    rows = np.repeat(np.arange(len(n)), n)
    padded = np.concatenate([words, np.zeros(width, dtype="uint64")])
    place = np.arange(len(words))
    full = place + width <= bounds[1:][rows]
    short = (place == bounds[:-1][rows]) & (n[rows] < width)
    at = np.flatnonzero(full | short)
    h = np.zeros(len(at), dtype="uint64")
    factor = _ODD
    for k in range(width):
        inside = at + k < bounds[1:][rows[at]]
        h = h * factor + np.where(inside, padded[at + k], np.uint64(0))
    return mix(h), rows[at]


def occurrences(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes sorted within their rows, their rows, and each one's number 0.. among equals."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    place = np.arange(len(h))
    return h, rows, place - np.maximum.accumulate(np.where(new, place, 0))
