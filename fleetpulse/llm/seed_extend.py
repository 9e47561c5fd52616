"""Substring dedup over words (operator 13) by seed and extend.

Seeds are winnowed anchors: of every window of ``LENGTH`` words the run of ``SEED`` words with the least
hash, the first of equals. Equal windows have equal seeds at the same place in them, so a repeat of
``LENGTH`` words or more is found through the seeds that documents join on; seeds that occur once drop
out. An occurrence of a shared seed is extended both ways, by ``s`` words to the left and the rest of
``LENGTH`` to the right for every ``s`` by which the seed stays its window's least run. Extensions that
meet another equal one are repeats; those that touch or overlap make up a maximal repeat, and its words
are removed wherever it occurs.

Occurrences are never compared pair by pair: an extension is known by its hash, and extensions are dealt
by that hash, so a seed that a third of all documents hold is spread over all tasks. Documents are dealt
to groups of bounded size once, and all three passes read the same shuffled texts; a group sends each
seed and each extension once, with a mark if it holds it more than once.
"""

from __future__ import annotations

import hashlib
import math
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import mix, span_hashes, text_bytes, word_spans
from fleetpulse.llm.common import text_of

#: Words of the strings that are looked for, and of a seed.
LENGTH, SEED = 35, 12
#: Bytes of text in a group of documents, and those for each bucket of extensions.
GROUP_BYTES, BUCKET_BYTES = 3 << 20, 10 << 20
#: Words that are hashed in one step; a word of so many bytes is hashed on its own.
HASHED_TOGETHER, LONG_WORD = 1 << 18, 1 << 10

_PLACE_BITS = 32  # a cell of a column has fewer words than that
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_SEEDS = "seed long, member long"  # group in the upper 32 bits, its occurrences (1 or 2) in the lower
_PIECES = "bucket int, grp int, packed binary"
_REPLIES = "grp int, kind string, seed long, packed binary"
_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_SPANS = "doc_id long, start long, end long"


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word."""
    out = np.empty(len(starts), dtype="uint64")
    long = ends - starts >= LONG_WORD
    for place in np.flatnonzero(long):
        out[place] = xxhash.xxh3_64_intdigest(data[starts[place]:ends[place]].tobytes())
    short = np.flatnonzero(~long)
    for begin in range(0, len(short), HASHED_TOGETHER):
        some = short[begin:begin + HASHED_TOGETHER]
        out[some] = span_hashes(data, starts[some], ends[some])
    return out


class Runs:
    """Hashes of runs of words, each in a few steps whatever its length."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        powers, self.inverse = (np.full(n, np.uint64(f), dtype="uint64") for f in (_FACTOR, _INVERSE))
        powers[0] = self.inverse[0] = 1
        np.cumprod(powers, out=powers)
        np.cumprod(self.inverse, out=self.inverse)
        self.sums = np.zeros(n, dtype="uint64")
        np.cumsum(mix(words + np.uint64(1)) * powers[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mix((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])


def seeds(runs: Runs, bounds: np.ndarray, length: int, seed: int):
    """Stretches of windows of one row with the same seed: first and last window, and the seed's hash.

    ``bounds`` has the n + 1 word offsets of the rows. Rows of fewer than ``length`` words have none.
    """
    none = np.zeros(0, dtype="int64")
    n = int(bounds[-1])
    if n < length:
        return none, none, none.astype("uint64")
    hashes = runs.of(np.arange(n - seed + 1), seed)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype="uint64")
    span, width = length - seed + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:width - span], least[span - width:])
    chosen = (least & low).astype("int64")
    starts = np.arange(len(chosen))
    row = np.searchsorted(bounds, starts, "right") - 1
    inside = starts + length <= bounds[row + 1]
    starts, chosen, row = starts[inside], chosen[inside], row[inside]
    if not len(starts):
        return none, none, none.astype("uint64")
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return starts[at], starts[np.r_[at[1:], len(starts)] - 1], hashes[chosen[at]]


class _Group:
    """The texts of a group: their words, and the stretches of windows of each seed."""

    def __init__(self, left: pa.Table, length: int, seed: int):
        column = left["text"].combine_chunks()
        self.table, self.length = left, length
        self.data, self.offsets = text_bytes(
            pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column)
        starts, ends, self.bounds = word_spans(self.data, self.offsets)
        self.runs = Runs(word_hashes(self.data, starts, ends))
        self.first, self.last, seeds_ = seeds(self.runs, self.bounds, length, seed)
        self.seed = seeds_.view("int64")

    def extensions(self, shared: np.ndarray):
        """First words of all windows of the given seeds, their hashes, which are even, and for
        each whether the group has it again."""
        mask = np.isin(self.seed, shared)
        first, count = self.first[mask], (self.last - self.first)[mask] + 1
        starts = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
        keys = self.runs.of(starts, self.length) & ~np.uint64(1)
        order = np.argsort(keys)
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        again = np.empty(len(keys), dtype=bool)
        again[order] = np.r_[equal, False] | np.r_[False, equal]
        return starts, keys, again

    def removed(self, starts: np.ndarray) -> np.ndarray:
        """Whether each word is in a window that begins at one of ``starts``."""
        size = int(self.bounds[-1]) + 1
        return np.cumsum(np.bincount(starts, minlength=size)
                         - np.bincount(starts + self.length, minlength=size))[:-1] > 0


def _of_kind(right: pa.Table, kind: str) -> pa.Table:
    return right.filter(pa.compute.equal(right["kind"], kind))


def _meet(table: pa.Table) -> pa.Table:
    """Tell each group which of its single extensions in the bucket other groups have too."""
    parts = [np.frombuffer(p, dtype="uint64") for p in table["packed"].to_pylist()]
    told = np.concatenate(parts)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    keys, again = told & ~np.uint64(1), (told & np.uint64(1)).astype(bool)
    order = np.argsort(keys)
    keys, again, owner = keys[order], again[order], owner[order]
    equal = keys[1:] == keys[:-1]
    news = (np.r_[equal, False] | np.r_[False, equal]) & ~again
    keys, owner = keys[news], owner[news]
    by_owner = np.argsort(owner, kind="stable")
    keys, owner = keys[by_owner], owner[by_owner]
    edges = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else owner
    packed = [x.tobytes() for x in np.split(keys, edges[1:])] if len(owner) else []
    groups = table["grp"].to_numpy()
    return pa.table({"grp": pa.array(groups[owner[edges]], pa.int32()),
                     "kind": pa.array(["found"] * len(packed), pa.string()),
                     "seed": pa.nulls(len(packed), pa.int64()),
                     "packed": pa.array(packed, pa.binary())})


def _empty(**types: pa.DataType) -> pa.Table:
    return pa.table({name: pa.array([], kind) for name, kind in types.items()})


def _through_seeds(docs: DataFrame, length: int, seed: int, group_bytes: int, bucket_bytes: int,
                   report, schema: str) -> DataFrame:
    """``report(group, first words of repeated windows)`` for every group of documents."""
    text = text_of("text")
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups, buckets = (max(1, math.ceil(size / of)) for of in (group_bytes, bucket_bytes))
    dealt = read.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("grp"),
                        "doc_id", "text")

    def send_seeds(left: pa.Table) -> pa.Table:
        group = _Group(left, length, seed)
        own, count = np.unique(group.seed, return_counts=True)
        member = (left["grp"][0].as_py() << 32) + np.minimum(count, 2)
        return pa.table({"seed": pa.array(own), "member": pa.array(member, pa.int64())})

    def send_extensions(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _empty(bucket=pa.int32(), grp=pa.int32(), packed=pa.binary())
        group = _Group(left, length, seed)
        _, keys, again = group.extensions(_of_kind(right, "shared")["seed"].to_numpy())
        told = np.unique(keys | again)
        bucket = (told >> np.uint64(1)) % np.uint64(buckets)
        by_bucket = np.argsort(bucket, kind="stable")
        told, bucket = told[by_bucket], bucket[by_bucket].astype("int64")
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(told) else bucket
        packed = [x.tobytes() for x in np.split(told, edges[1:])] if len(told) else []
        return pa.table({"bucket": pa.array(bucket[edges], pa.int32()),
                         "grp": pa.array([left["grp"][0].as_py()] * len(packed), pa.int32()),
                         "packed": pa.array(packed, pa.binary())})

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return report(None, None)
        group = _Group(left, length, seed)
        starts, keys, again = group.extensions(_of_kind(right, "shared")["seed"].to_numpy())
        found = _of_kind(right, "found")["packed"].to_pylist()
        told = np.frombuffer(b"".join(found), dtype="uint64")
        return report(group, starts[again | np.isin(keys, told)])

    def with_group(told: DataFrame, step, kind: str) -> DataFrame:
        return dealt.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(step, kind)

    # counted by a column that the join needs too, so that both read the same shuffled seeds
    sent = dealt.groupBy("grp").applyInArrow(send_seeds, _SEEDS).repartition("seed")
    often = sent.groupBy("seed").agg(
        F.sum(F.col("member").bitwiseAND(F.lit((1 << 32) - 1))).alias("n")).filter("n > 1")
    shared = sent.join(often, "seed").select(
        F.shiftright("member", 32).cast("int").alias("grp"), F.lit("shared").alias("kind"), "seed",
        F.lit(None).cast("binary").alias("packed"))
    pieces = with_group(shared, send_extensions, _PIECES)
    replies = pieces.groupBy("bucket").applyInArrow(_meet, _REPLIES)
    return with_group(shared.unionByName(replies), finish, schema)


def _kept(group: _Group | None, starts: np.ndarray) -> pa.Table:
    types = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(),
             "kept_sha256": pa.string()}
    if group is None:
        return _empty(**types)
    kept = ~group.removed(starts)
    total = np.r_[0, np.cumsum(kept)]
    digests = []
    for row in range(group.table.num_rows):
        begin, end = group.bounds[row], group.bounds[row + 1]
        words = group.data[group.offsets[row]:group.offsets[row + 1]].tobytes().split()
        if total[end] - total[begin] < end - begin:
            words = compress(words, kept[begin:end].tolist())
        digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
    n_words = np.diff(group.bounds)
    return pa.Table.from_arrays(
        [group.table["doc_id"].cast(pa.int64()), pa.array(n_words),
         pa.array(n_words - np.diff(total[group.bounds])), pa.array(digests, pa.string())],
        names=list(types))


def _spans(group: _Group | None, starts: np.ndarray) -> pa.Table:
    if group is None:
        return _empty(doc_id=pa.int64(), start=pa.int64(), end=pa.int64())
    gone = np.r_[False, group.removed(starts), False]
    inner = group.bounds[1:-1]
    begins = np.r_[np.flatnonzero(~gone[:-1] & gone[1:]), inner[gone[inner] & gone[inner + 1]]]
    ends = np.r_[np.flatnonzero(gone[:-1] & ~gone[1:]), inner[gone[inner] & gone[inner + 1]]]
    begins, ends = np.unique(begins), np.unique(ends)
    row = np.searchsorted(group.bounds, begins, "right") - 1
    return pa.table({"doc_id": group.table["doc_id"].cast(pa.int64()).take(pa.array(row)),
                     "start": pa.array(begins - group.bounds[row]),
                     "end": pa.array(ends - group.bounds[row])})


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED,
          group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of ``length`` words that covers it begins anywhere else too, in the same
    row or another; the first occurrence goes like all others. Words are the runs of bytes other than
    ASCII white space, unchanged. Null counts as empty; texts of fewer than ``length`` words lose
    nothing. Rows with equal or null doc_id are rows of their own, so repeated rows lose all their
    windows. Other columns are not read; an empty table gives no rows. A very long text is a group by
    itself; its words are hashed in steps.
    """
    return _through_seeds(docs, length, seed, group_bytes, bucket_bytes, _kept, _RESULT)


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED,
            group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The stretches that ``dedup`` removes: doc_id and the first word and the word behind the last.

    Counted in words of the row from 0; stretches that touch are one.
    """
    return _through_seeds(docs, length, seed, group_bytes, bucket_bytes, _spans, _SPANS)


def oracle(length: int = LENGTH) -> str:
    """The query op13_seed_extend in DuckDB's SQL: all windows, counted."""
    return f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
    '[ \\t-\\r]+'), lambda x: x <> '') AS words FROM documents),
place AS (SELECT doc_id, words, unnest(range(1, len(words) - {length - 2})) AS k FROM w),
win AS (SELECT doc_id, k, array_to_string(words[k:k + {length - 1}], ' ') AS run FROM place),
again AS (SELECT doc_id, k FROM win QUALIFY count(*) OVER (PARTITION BY run) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + {length})) AS k FROM again),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS text
  FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words) - coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""
