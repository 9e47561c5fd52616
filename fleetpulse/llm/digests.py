"""Document fingerprints (operator 6): quartile digests of hashed byte triplets.

A text's byte triplets are counted in 256 buckets by hash. The digest holds, for each bucket, which
quartile of the bucket counts it is in (two bits), the logarithm of the length and the relations of
the quartiles. Digests differ by a bounded score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import steps, text_bytes
from fleetpulse.llm.common import checkpoint

BUCKETS = 256
#: The most that two digests can differ: about what texts without relation differ by.
BOUND = 416
_FAR = np.array([0, 1, 2, 6])  # opposite quartiles count double, as twice the step
_HEAD = 3  # bytes before the quartile codes: length, two ratios


def digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of 3 + 64 bytes for every text; a text of less than three bytes has no triplets."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    counts = np.zeros((n, BUCKETS), dtype="int64")
    if len(data) >= 3:
        x = data.astype("uint32")
        triplet = x[:-2] | x[1:-1] << np.uint32(8) | x[2:] << np.uint32(16)
        bucket = (triplet * np.uint32(2654435761)) >> np.uint32(24)
        rows = np.repeat(np.arange(n), lengths)[:-2]
        inside = np.ones(len(rows), dtype=bool)
        inner = offsets[1:-1]
        for back in (1, 2):
            cut = inner - back
            inside[cut[(cut >= 0) & (cut < len(inside))]] = False
        counts = np.bincount(rows[inside] * BUCKETS + bucket[inside],
                             minlength=n * BUCKETS).reshape(n, BUCKETS)
    ranked = np.sort(counts, axis=1)
    quarters = ranked[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = (counts[:, :, None] > quarters[:, None, :]).sum(axis=2).astype("uint8")
    packed = (codes[:, 0::4] | codes[:, 1::4] << 2 | codes[:, 2::4] << 4 | codes[:, 3::4] << 6)
    head = np.zeros((n, _HEAD), dtype="uint8")
    head[:, 0] = np.minimum(np.log(lengths + 1.0) * 10, 255)
    top = np.maximum(quarters[:, 2], 1)
    head[:, 1:] = quarters[:, :2] * 15 // top[:, None]
    return np.concatenate([head, packed.astype("uint8")], axis=1)


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for those that differ by ``BOUND`` or more."""
    a, b = one.astype("int64"), other.astype("int64")
    score = np.minimum(np.abs(a[:, 0] - b[:, 0]), 24) + np.abs(a[:, 1:_HEAD]
                                                            - b[:, 1:_HEAD]).sum(axis=1)
    for shift in (0, 2, 4, 6):
        score += _FAR[np.abs((a[:, _HEAD:] >> shift & 3) - (b[:, _HEAD:] >> shift & 3))].sum(axis=1)
    return 1.0 - np.minimum(score, BOUND) / BOUND


def digest_texts(texts: list[str]) -> np.ndarray:
    return digests(*text_bytes(pa.array(texts, type=pa.large_string())))


def edited(text: str, following: str) -> str:
    """``text`` with its last half, rounded down, replaced by the first as many of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``doc_id`` and the hexadecimal digest of every text; null and empty texts alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            rows = digests(*text_bytes(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([r.tobytes().hex() for r in rows])],
                names=["doc_id", "fingerprint"])

    return docs.select(F.col(f"`{id_column}`").alias("doc_id"),
                       F.col(f"`{text_column}`").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


_RESULT = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(),
    "fingerprint": pa.string(), "edited_fingerprint": pa.string(),
    "near_edited": pa.float64(), "near_next": pa.float64(),
}
_RESULT_SQL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
               "edited_fingerprint string, near_edited double, near_next double")
_EDGE = {"part": pa.int32(), "edge": pa.string(), "text": pa.string()}


def _compared(ids: list, texts: list[str], following: list[str]) -> list[pa.Array]:
    """The result columns of texts and the texts that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    own, other, after = map(digest_texts, (texts, changed, following))
    return [
        pa.array(ids, type=pa.int64()),
        pa.array([len(t) for t in texts], type=pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], type=pa.string()),
        pa.array([r.tobytes().hex() for r in own], type=pa.string()),
        pa.array([r.tobytes().hex() for r in other], type=pa.string()),
        pa.array(likeness(own, other), type=pa.float64()),
        pa.array(likeness(own, after), type=pa.float64()),
    ]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows of a sorted partition but the last, and its first and last text."""
    part = TaskContext.get().partitionId()
    schema = pa.schema(list((_RESULT | _EDGE).items()))

    def edge(doc, text, name):
        row = {name_: [None] for name_ in schema.names}
        row |= {"doc_id": [doc], "part": [part], "edge": [name], "text": [text]}
        return pa.RecordBatch.from_pydict(row, schema=schema)

    held = None
    for batch in steps(batches):
        ids = batch.column(0).to_pylist()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        if held is None:
            yield edge(ids[0], texts[0], "first")
        else:
            ids, texts = [held[0], *ids], [held[1], *texts]
        held = ids[-1], texts[-1]
        if len(ids) > 1:
            empty = [pa.nulls(len(ids) - 1, type=t) for t in _EDGE.values()]
            yield pa.RecordBatch.from_arrays(
                [*_compared(ids[:-1], texts[:-1], texts[1:]), *empty], schema=schema)
    if held is not None:
        yield edge(*held, "last")


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, following = (batch.column(k).to_pylist() for k in range(3))
        yield pa.RecordBatch.from_arrays(
            _compared(ids, texts, following), schema=pa.schema(list(_RESULT.items())))


def compare_edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs``, its edited text, and their likeness.

    The next document is the next by ascending doc_id (null first; ties by a hash of the text, then
    as read); after the last comes the first, and a single document follows itself. Null counts as
    empty. Rows are dealt by range of that order and compared inside their partition; only each
    partition's first and last text go to a second, small step.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie"), F.col("place")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    found = checkpoint(dealt.mapInArrow(_in_order, f"{_RESULT_SQL}, part int, edge string, text string"))
    inner = found.filter("edge IS NULL").select(*_RESULT)
    # one row for each partition: which partition follows
    parts = sorted(r[0] for r in found.filter("edge = 'last'").select("part").collect())
    follows = list(zip(parts, parts[1:] + parts[:1]))
    links = docs.sparkSession.createDataFrame(follows, "part int, next_part int")
    lasts = found.filter("edge = 'last'").select("part", "doc_id", "text")
    firsts = found.filter("edge = 'first'").select(F.col("part").alias("next_part"),
                                                   F.col("text").alias("following"))
    pairs = lasts.join(links, "part").join(firsts, "next_part").select("doc_id", "text", "following")
    return inner.unionByName(pairs.mapInArrow(_across, _RESULT_SQL))
