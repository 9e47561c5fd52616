"""Suffix dedup (operator 8): remove bytes covered by long strings that earlier documents have.

A string of 50 bytes is found again through its anchor (see ``window_order``), so suffixes can be
dealt out: first anchors that only one group of documents has are dropped, then the windows around
the others meet by anchor, the shards' windows are merged into one order by interleave refinement,
and the intervals with a common prefix of 50 bytes tell the first document of each string. Groups of
documents hold a bounded number of bytes and send each anchor and each distinct context once, so that a
string that very many documents share arrives once from each group. At the edges of such a string the
contexts hold text of each document's own; an anchor with that many contexts is hot, and its windows are
dealt one by one, by their own hashes.

Matches never cross documents, and strings are judged on the texts as they came. The documents are
dealt to groups once, and all three passes over them read the same shuffled texts.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import span_hashes, text_bytes
from fleetpulse.llm.common import text_of
from fleetpulse.llm.window_order import LENGTH, gather, merge_windows, stretches

#: Bytes of text in a group of documents.
GROUP_BYTES = 3 << 20
#: Bytes of text for each bucket of anchors that one task merges.
BUCKET_BYTES = 10 << 20
#: Bits of an anchor's hash beyond those that number all anchors: few are equal by chance.
SPARE_BITS = 12
#: Windows that are merged in one step; a bucket's anchors are taken in order of their hashes.
MERGED_TOGETHER = 1 << 20

#: Contexts of an anchor beyond which its windows are dealt one by one.
HOT_CONTEXTS = 1 << 17
#: Stretches of an anchor in a group beyond which their distinct contexts are counted.
COUNTED = 12
#: Windows that are hashed in one step.
HASHED_TOGETHER = 1 << 16

_ANCHORS = "anchor long, member long"  # group in the upper 32 bits, its contexts in the lower
_CONTEXTS = "bucket int, grp int, packed binary"
_REPLIES = "grp int, anchor long, key long, low int, high int, least long"
_RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


class _Group:
    """The documents of a group in a fixed order, and the stretches of those that take part."""

    def __init__(self, left: pa.Table, copies: np.ndarray, bits: int):
        order = pa.compute.sort_indices(left, sort_keys=[("row", "ascending")])
        self.table = left.take(order).combine_chunks()
        self.row = self.table["row"].to_numpy()
        self.doc = self.table["ord"].to_numpy()
        self.copy = np.isin(self.row, copies)
        texts = self.table["text"].combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
        self.data, self.offsets = text_bytes(texts)
        first, last, anchor, at, rows = stretches(self.data, self.offsets)
        taken = ~self.copy[rows]
        self.first, self.last, self.rows = first[taken], last[taken], rows[taken]
        self.at = at[taken]
        self.anchor = (anchor[taken] >> np.uint64(64 - bits)).astype("int64")

    def keep(self, mask: np.ndarray) -> None:
        self.first, self.last, self.rows, self.anchor, self.at = (
            x[mask] for x in (self.first, self.last, self.rows, self.anchor, self.at))

    def contexts(self):
        """Bytes and offsets of the stretches' contexts, and a key for each."""
        data, offsets = gather(self.data, self.first, self.last - self.first + LENGTH)
        return data, offsets, span_hashes(data, offsets[:-1], offsets[1:]).view("int64")


    def windows(self, mask: np.ndarray):
        """Places, anchors and their places, rows and keys of the single windows of the stretches in
        ``mask``."""
        count = (self.last - self.first + 1)[mask]
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        starts = np.repeat(self.first[mask], count) + inner
        keys = np.empty(len(starts), dtype="int64")
        for a in range(0, len(starts), HASHED_TOGETHER):
            some = starts[a:a + HASHED_TOGETHER]
            data, offsets = gather(self.data, some, np.full(len(some), LENGTH))
            keys[a:a + len(some)] = span_hashes(data, offsets[:-1], offsets[1:]).view("int64")
        anchor, at, rows = (np.repeat(x[mask], count) for x in (self.anchor, self.at, self.rows))
        return starts, anchor, at, rows, keys


def _right(table: pa.Table, kind: str) -> pa.Table:
    return table.filter(pa.compute.equal(table["kind"], kind))


def _firsts(keys: np.ndarray, docs: np.ndarray):
    """For distinct keys: one place of each, and the least document; and each place's number."""
    distinct, place, number = np.unique(keys, return_index=True, return_inverse=True)
    least = np.full(len(distinct), np.iinfo("int64").max)
    np.minimum.at(least, number, docs)
    return place, least, number


def _pack(anchor: np.ndarray, least: np.ndarray, at: np.ndarray, data: np.ndarray,
          offsets: np.ndarray) -> bytes:
    """Contexts of one group and bucket as one compressed piece."""
    head = np.array([len(anchor)], dtype="int64")
    lengths = np.diff(offsets).astype("int16")
    parts = (head, anchor, least, lengths, at.astype("uint8"), data)
    return zlib.compress(b"".join(x.tobytes() for x in parts), 1)


def _unpack(packed: bytes):
    """Anchors, least documents, lengths, anchors' places and bytes of the contexts of a piece."""
    raw = np.frombuffer(zlib.decompress(packed), dtype="uint8")
    n = int(raw[:8].view("int64")[0])
    cuts = 8 + np.cumsum([0, 8 * n, 8 * n, 2 * n, n])
    anchor, least, lengths, at = (raw[a:b].copy().view(t) for a, b, t in zip(
        cuts[:-1], cuts[1:], ("int64", "int64", "int16", "uint8")))
    return anchor, least, lengths.astype("int64"), at.astype("int64"), raw[cuts[-1]:]


def _merge_bucket(table: pa.Table) -> pa.Table:
    """The least document of every window in the bucket, for those groups that don't know it.

    Buckets of single windows have numbers below 0, and so has ``low`` in their replies.
    """
    single = table["bucket"][0].as_py() < 0
    parts = [_unpack(p) for p in table["packed"].to_pylist()]
    anchors, least, lengths, anchor_at, data = (np.concatenate(x) for x in zip(*parts))
    groups = np.repeat(table["grp"].to_numpy(), [len(p[0]) for p in parts])
    offsets = np.r_[0, np.cumsum(lengths)]
    keys = span_hashes(data, offsets[:-1], offsets[1:]).view("int64")
    place, first_doc, number = _firsts(keys, least)
    data, offsets = gather(data, offsets[:-1][place], lengths[place])
    # equal windows have equal anchors: whole anchors at a time, up to so many windows
    by_anchor = np.argsort(anchors[place], kind="stable")
    windows = (np.diff(offsets) - LENGTH + 1)[by_anchor]
    ordered = anchors[place][by_anchor]
    ends = np.flatnonzero(np.r_[ordered[1:] != ordered[:-1], True]) + 1
    done = np.cumsum(windows)
    begin = 0
    least_of = np.repeat(first_doc, np.diff(offsets) - LENGTH + 1)  # by context, then window
    number_of = np.cumsum(np.r_[False, ordered[1:] != ordered[:-1]]) if len(ordered) else ordered
    window_at = np.zeros(len(place) + 1, dtype="int64")
    np.cumsum(np.diff(offsets) - LENGTH + 1, out=window_at[1:])
    while begin < len(by_anchor):
        limit = (done[begin - 1] if begin else 0) + MERGED_TOGETHER
        within = ends[(ends > begin) & (done[ends - 1] <= limit)]
        end = int(within[-1]) if len(within) else int(ends[np.searchsorted(ends, begin, "right")])
        some = by_anchor[begin:end]
        count = np.diff(offsets)[some] - LENGTH + 1
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        starts = np.repeat(offsets[:-1][some], count) + inner
        order, interval = merge_windows(
            data, starts, np.repeat(number_of[begin:end] - number_of[begin], count),
            np.repeat(anchor_at[place][some], count) - inner)
        if len(order):
            docs = np.repeat(first_doc[some], count)[order]
            low = np.minimum.reduceat(
                docs, np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]]))
            least_of[(np.repeat(window_at[some], count) + inner)[order]] = low[interval]
        begin = end
    # tell each group of each context the windows whose first document it doesn't hold
    count = (np.diff(offsets) - LENGTH + 1)[number]
    inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    entry = np.repeat(np.arange(len(keys)), count)
    found = least_of[np.repeat(window_at[number], count) + inner]
    news = found < least[entry]
    entry, inner, found = entry[news], inner[news], found[news]
    new = np.ones(len(entry), dtype=bool)
    new[1:] = ((entry[1:] != entry[:-1]) | (inner[1:] != inner[:-1] + 1)
               | (found[1:] != found[:-1]))
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(entry)] - 1
    return pa.table({"grp": pa.array(groups[entry[at]], pa.int32()),
                     "anchor": pa.array(anchors[entry[at]], pa.int64()),
                     "key": pa.array(keys[entry[at]], pa.int64()),
                     "low": pa.array(inner[at] - int(single), pa.int32()),
                     "high": pa.array(inner[last] if len(at) else inner[:0], pa.int32()),
                     "least": pa.array(found[at], pa.int64())})


def _covered(group: _Group, replies: pa.Table) -> np.ndarray:
    """Bytes of the group that a string of an earlier document covers."""
    single = replies.filter(pa.compute.less(replies["low"], 0))
    replies = replies.filter(pa.compute.greater_equal(replies["low"], 0))
    starts, _, _, rows, keys = group.windows(np.isin(group.anchor, single["anchor"].to_numpy()))
    told, at = np.unique(single["key"].to_numpy(), return_index=True)
    at = at[np.minimum(np.searchsorted(told, keys), len(told) - 1)] if len(told) else keys
    hit = ((single["key"].to_numpy()[at] == keys)
           & (group.doc[rows] > single["least"].to_numpy()[at])) if len(told) else keys > keys
    begins, ends = [starts[hit]], [starts[hit] + LENGTH]
    _, number, count = np.unique(group.anchor, return_inverse=True, return_counts=True)
    group.keep((count[number] > 1) | np.isin(group.anchor, replies["anchor"].to_numpy()))
    keys = group.contexts()[2]
    docs = group.doc[group.rows]
    _, least, number = _firsts(keys, docs)
    size = len(group.data) + 1
    later = docs > least[number]
    begins.append(group.first[later])
    ends.append(group.last[later] + LENGTH)
    by_key = np.argsort(replies["key"].to_numpy(), kind="stable")
    told = replies["key"].to_numpy()[by_key]
    begin, end = np.searchsorted(told, keys, "left"), np.searchsorted(told, keys, "right")
    count = end - begin
    entry = np.repeat(np.arange(len(keys)), count)
    at = by_key[np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                + np.repeat(begin, count)]
    hit = docs[entry] > replies["least"].to_numpy()[at]
    entry, at = entry[hit], at[hit]
    begins.append(group.first[entry] + replies["low"].to_numpy()[at])
    ends.append(group.first[entry] + replies["high"].to_numpy()[at] + LENGTH)
    covered = np.cumsum(np.bincount(np.concatenate(begins), minlength=size)
                        - np.bincount(np.concatenate(ends), minlength=size))[:-1] > 0
    # a copy of an earlier text is covered whole, if it holds a string at all
    lengths = np.diff(group.offsets)
    covered |= np.repeat(group.copy & (lengths >= LENGTH), lengths)
    return covered


def dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES,
          bucket_bytes: int = BUCKET_BYTES, hot_contexts: int = HOT_CONTEXTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null counts as empty; texts under 50 bytes lose nothing. A null doc_id is before all others.
    Rows with the same doc_id are the same document and take nothing from each other. Other columns
    are not read; an empty table gives no rows.
    """
    text = text_of("text")
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("ord"),
        F.monotonically_increasing_id().alias("row"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    groups = max(1, math.ceil(size / group_bytes))
    buckets = max(1, math.ceil(size / bucket_bytes))
    bits = min(62, max(24, math.ceil(math.log2(size + 2)) - 4 + SPARE_BITS))
    grp = F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("grp")
    dealt = read.select(grp, "doc_id", "ord", "row", "text")

    hashed = read.select(grp, "row", "ord", F.xxhash64("text").alias("h1"),
                         F.xxhash64(F.lit(1), "text").alias("h2"))
    copies = (hashed.join(hashed.groupBy("h1", "h2").agg(F.min("ord").alias("least")),
                          ["h1", "h2"]).filter("ord > least").select("grp", "row"))
    nothing = F.lit(None)
    copied = copies.select("grp", F.lit("copy").alias("kind"), F.col("row").alias("a"),
                           nothing.cast("long").alias("anchor"), nothing.cast("int").alias("low"),
                           nothing.cast("int").alias("high"), nothing.cast("long").alias("least"))

    def open_group(left: pa.Table, right: pa.Table) -> _Group:
        return _Group(left, _right(right, "copy")["a"].to_numpy(), bits)

    def send_anchors(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({"anchor": pa.array([], pa.int64()), "member": pa.array([], pa.int64())})
        group = open_group(left, right)
        own, number, counts = np.unique(group.anchor, return_inverse=True, return_counts=True)
        often = counts > COUNTED
        if often.any():
            group.keep(often[number])
            place = np.unique(group.contexts()[2], return_index=True)[1]
            found, distinct = np.unique(group.anchor[place], return_counts=True)
            counts[np.searchsorted(own, found)] = distinct
        return pa.table({"anchor": pa.array(own, pa.int64()), "member": pa.array(
            (left["grp"][0].as_py() << 32) + counts, pa.int64())})

    def send_contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        names, types = ["bucket", "grp", "packed"], [pa.int32(), pa.int32(), pa.binary()]
        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        group = open_group(left, right)
        starts, anchor, at, rows, keys = group.windows(
            np.isin(group.anchor, _right(right, "hot")["a"].to_numpy()))
        docs = group.doc[rows]
        place, least, number = _firsts(keys, docs)
        # the last document goes too: any but the first learns of the first by the reply
        most = least.copy()
        np.maximum.at(most, number, docs)
        place, least = (np.r_[x, y[most > least]] for x, y in ((place, place), (least, most)))
        single = -1 - (keys[place].view("uint64") % np.uint64(buckets)).astype("int64")
        parts = [(starts[place], np.full(len(place), LENGTH), anchor[place], least,
                  (at - starts)[place], single)]
        group.keep(np.isin(group.anchor, _right(right, "anchor")["a"].to_numpy()))
        place, least, _ = _firsts(group.contexts()[2], group.doc[group.rows])
        anchor = group.anchor[place]
        parts.append((group.first[place], (group.last - group.first)[place] + LENGTH, anchor, least,
                      (group.at - group.first)[place], anchor % buckets))
        first, length, anchor, least, at, bucket = (np.concatenate(x) for x in zip(*parts))
        by_bucket = np.argsort(bucket, kind="stable")
        first, length, anchor, least, at, bucket = (
            x[by_bucket] for x in (first, length, anchor, least, at, bucket))
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        packed = [_pack(anchor[a:b], least[a:b], at[a:b],
                        *gather(group.data, first[a:b], length[a:b]))
                  for a, b in zip(edges, [*edges[1:], len(bucket)])]
        return pa.Table.from_arrays([
            pa.array(bucket[edges].astype("int32") if len(edges) else [], pa.int32()),
            pa.array([left["grp"][0].as_py()] * len(packed), pa.int32()),
            pa.array(packed, pa.binary())], names=names)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        types = [pa.int64()] * 4 + [pa.string()]
        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], t) for t in types], names=names)
        group = open_group(left, right)
        replies = _right(right, "reply")
        covered = _covered(group, replies.rename_columns({"a": "key"}))
        begins = covered.copy()
        begins[1:] &= ~covered[:-1]
        inner = group.offsets[(group.offsets > 0) & (group.offsets < len(covered))]
        begins[inner] = covered[inner]
        total = np.r_[0, np.cumsum(covered)]
        spans = np.r_[0, np.cumsum(begins)]
        at, end = group.offsets[:-1], group.offsets[1:]
        digests = [hashlib.sha256(group.data[a:b][~covered[a:b]].tobytes()).hexdigest()
                   for a, b in zip(at, end)]
        return pa.Table.from_arrays([
            group.table["doc_id"].cast(pa.int64()), pa.array(end - at),
            pa.array(total[end] - total[at]), pa.array(spans[end] - spans[at]),
            pa.array(digests, pa.string())], names=names)

    def with_group(told: DataFrame, step, schema: str) -> DataFrame:
        return dealt.groupBy("grp").cogroup(told.groupBy("grp")).applyInArrow(step, schema)

    def as_told(df: DataFrame, kind: str | Column, a: str, replies: bool = False) -> DataFrame:
        rest = ["anchor", "low", "high", "least"] if replies else [
            nothing.cast("long").alias("anchor"), nothing.cast("int").alias("low"),
            nothing.cast("int").alias("high"), nothing.cast("long").alias("least")]
        return df.select("grp", F.lit(kind).alias("kind"), F.col(a).alias("a"), *rest)

    anchors = with_group(copied, send_anchors, _ANCHORS).repartition("anchor")
    # counted by a column that the join needs too, so that both read the same shuffled anchors
    shared = anchors.groupBy("anchor").agg(F.sum(F.col("member").bitwiseAND(
        F.lit((1 << 32) - 1))).alias("n")).filter("n > 1")
    known = anchors.join(shared, "anchor").select(
        F.shiftright("member", 32).cast("int").alias("grp"), "anchor",
        F.when(F.col("n") > hot_contexts, "hot").otherwise("anchor").alias("kind"))
    contexts = with_group(copied.unionByName(as_told(known, F.col("kind"), "anchor")),
                          send_contexts, _CONTEXTS)
    replies = contexts.groupBy("bucket").applyInArrow(_merge_bucket, _REPLIES)
    return with_group(copied.unionByName(as_told(replies, "reply", "key", replies=True)),
                      finish, _RESULT)
