"""Vector code compression (operator 12): product codes by member-resident Lloyd.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook of its
own. The parts are the members of their entries: they lie partitioned by (position, entry, salt), packed
many to a row. In each round the owners add up their resident members, the sums of a few thousand
numbers make the new codebooks, and every member is held against its position's new codebook where it
lies. Only members that change their entry migrate in the next shuffle; the others are written again
without one. The salt spreads an entry that holds a large share of all members over many owners.

Everything is exact: whole numbers, floors, ties to the lower index. What goes through the driver is the
codebooks and their sums, entries times dimensions whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import written

#: Parts of a vector, entries of a codebook, rounds of Lloyd's update, steps to the unit.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components are held within this many steps of 0, so that a vector's error fits in a long.
FARTHEST = 1 << 26
#: Vectors whose parts are packed together, parts that are compared in one step, and members of one
#: entry and salt.
PACKED_TOGETHER, COMPARED_TOGETHER, OWNED = 1 << 13, 1 << 13, 1 << 16

_MEMBERS = ("position int, entry int, salt long, moved boolean, ids binary, parts binary")
_SUMS = "position int, entry int, component int, total long, members long"
_CODES = "row long, position int, entry int, distance long"


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entry of ``book`` nearest to each part, the lowest of equals, and its squared distance."""
    entry, least = np.empty(len(parts), dtype="int64"), np.empty(len(parts), dtype="int64")
    for begin in range(0, len(parts), COMPARED_TOGETHER):
        some = slice(begin, begin + COMPARED_TOGETHER)
        distance = np.zeros((len(parts[some]), len(book)), dtype="int64")
        for k in range(parts.shape[1]):
            gap = parts[some, k, None].astype("int64") - book[None, :, k]
            distance += gap * gap
        entry[some] = np.argmin(distance, axis=1)
        least[some] = distance[np.arange(len(distance)), entry[some]]
    return entry, least


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 6
    types = (pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)],
        names=["position", "entry", "salt", "moved", "ids", "parts"])


def _dealt(position: int, entry: np.ndarray, salt: np.ndarray, moved: bool, ids: np.ndarray,
           parts: np.ndarray) -> Iterator[tuple]:
    """A packed row for each entry and salt."""
    if not len(entry):
        return
    order = np.lexsort((entry, salt))
    entry, salt, ids, parts = entry[order], salt[order], ids[order], parts[order]
    edges = np.flatnonzero(np.r_[True, (entry[1:] != entry[:-1]) | (salt[1:] != salt[:-1]), True])
    for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield (position, int(entry[begin]), int(salt[begin]), moved, ids[begin:end].tobytes(),
               parts[begin:end].tobytes())


def _unpacked(batch: pa.RecordBatch, width: int) -> Iterator[tuple]:
    """For each position in the batch: entries, salts, ids and parts of its members."""
    of = {c: batch.column(c).to_pylist() for c in ("position", "entry", "salt", "ids", "parts")}
    rows: dict[int, list[int]] = {}
    for row, position in enumerate(of["position"]):
        rows.setdefault(position, []).append(row)
    for position, some in rows.items():
        ids = np.frombuffer(b"".join([of["ids"][r] for r in some]), "int64")
        parts = np.frombuffer(b"".join([of["parts"][r] for r in some]), "int32")
        count = [len(of["ids"][r]) // 8 for r in some]
        entry, salt = (np.repeat(np.array([of[c][r] for r in some], dtype="int64"), count)
                       for c in ("entry", "salt"))
        yield position, entry, salt, ids, parts.reshape(-1, width)


def _members(vectors: DataFrame, books: np.ndarray, salts: int) -> DataFrame:
    """All parts with their nearest entries of the first codebooks."""
    n_parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, PACKED_TOGETHER):
                some = batch.slice(begin, PACKED_TOGETHER)
                ids = some.column(0).to_numpy()
                parts = some.column(1).flatten().to_numpy().reshape(len(ids), n_parts, width)
                salt = np.full(len(ids), hash(int(ids[0])) % salts)
                yield _packed([row for p in range(n_parts) for row in _dealt(
                    p, nearest(parts[:, p], books[p])[0], salt, False, ids, parts[:, p])])

    return vectors.select("row", "vector").mapInArrow(run, _MEMBERS)


def _owned(members: DataFrame) -> DataFrame:
    """Members shuffled to the owners of their entries, and written there."""
    return written(members.repartition("position", "entry", "salt"))


def _reassigned(resident: DataFrame, books: np.ndarray) -> DataFrame:
    """Every member under new codebooks, where it lies; ``moved`` marks those that must migrate."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for position, entry, salt, ids, parts in _unpacked(batch, width):
                to = nearest(parts, books[position])[0]
                for moved, mask in ((False, to == entry), (True, to != entry)):
                    rows.extend(_dealt(
                        position, to[mask], salt[mask], moved, ids[mask], parts[mask]))
            yield _packed(rows)

    return resident.mapInArrow(run, _MEMBERS)


def _sums(resident: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """What each owner's members of an entry add up to, by component."""
    n_parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, dtype="int64")
        members = np.zeros((n_parts, entries), dtype="int64")
        for batch in batches:
            for position, entry, _, _, parts in _unpacked(batch, width):
                np.add.at(total[position], entry, parts.astype("int64"))
                members[position] += np.bincount(entry, minlength=entries)
        at = np.argwhere(np.repeat(members[:, :, None] > 0, width, axis=2))
        p, e, k = at.T
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x, pa.int32()) for x in (p, e, k)), pa.array(total[p, e, k]),
             pa.array(members[p, e])], names=["position", "entry", "component", "total", "members"])

    return resident.mapInArrow(run, _SUMS).groupBy("position", "entry", "component").agg(
        F.sum("total").alias("total"), F.sum("members").alias("members"))


def _updated(books: np.ndarray, resident: DataFrame) -> np.ndarray:
    """The codebooks' entries replaced by the floors of their members' means."""
    new = books.copy()
    for p, e, k, total, members in _sums(resident, books.shape).collect():
        new[p, e, k] = total // members
    return new


def _codes(resident: DataFrame, books: np.ndarray) -> DataFrame:
    """row, position, entry and squared distance of every part."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for position, _, _, ids, parts in _unpacked(batch, width):
                entry, distance = nearest(parts, books[position])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.full(len(ids), position, "int32")),
                     pa.array(entry.astype("int32")), pa.array(distance)],
                    names=["row", "position", "entry", "distance"])

    return resident.mapInArrow(run, _CODES)


def whole_numbers(vector: str, scale: int) -> Column:
    """The components as whole steps, floored and held within ``FARTHEST``."""
    def step(x: Column) -> Column:
        held = F.greatest(F.least(x.cast("double") * scale, F.lit(float(FARTHEST))),
                          F.lit(float(-FARTHEST)))
        return F.floor(held).cast("int")
    return F.transform(vector, step)


def _start(kept: DataFrame, entries: int, parts: int) -> np.ndarray:
    """The first codebooks: the vectors of the least ids, part by part."""
    ids = kept.select(F.col("vec_id").alias("least_id")).distinct().orderBy(
        F.col("least_id").asc_nulls_last()).limit(entries)
    first = (kept.join(F.broadcast(ids), F.col("vec_id").eqNullSafe(F.col("least_id")))
             .groupBy("least_id").agg(F.min("vector").alias("vector"))
             .orderBy(F.col("least_id").asc_nulls_last()).collect())
    vectors = np.array([r["vector"] for r in first], dtype="int64")
    return vectors.reshape(len(first), parts, -1).transpose(1, 0, 2)


def encode(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding",
           label_column: str = "label", owned: int = OWNED) -> DataFrame:
    """One row per vector that is kept: vec_id, code, error, label_error, codebooks_sha256.

    ``code`` has two hexadecimal digits for each part's entry, ``error`` is the squared distance of
    the vector to its code, ``label_error`` the sum of the errors of equal labels (null is a label of
    its own; a sum beyond a long stays at the greatest). Vectors that are null, empty, or hold null or
    non-finite components are dropped, and so are those whose length is not a multiple of ``parts`` or
    not that of the least kept id's vector. Components of 2^26 steps or more count as 2^26 steps.
    Fewer than ``entries`` ids give smaller codebooks; of several vectors with one of the least ids
    the least vector begins; a null id comes after all others. Repeated rows are encoded as rows of
    their own. Other columns are not read; an empty table gives no rows.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits")
    embedding = F.col(f"`{vector_column}`")
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x.cast("double")) < float("inf")))
    size = F.size(embedding)
    sound = embedding.isNotNull() & (size > 0) & (size % parts == 0) & finite
    read = written(vectors.filter(F.coalesce(sound, F.lit(False))).select(
        F.col(f"`{id_column}`").cast("long").alias("vec_id"),
        F.col(f"`{label_column}`").alias("label"),
        whole_numbers(f"`{vector_column}`", scale).alias("vector"))
        .withColumn("row", F.monotonically_increasing_id()))
    least = read.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(
        F.size("vector")).first()
    if least is None:
        return _described(read.select("row", "vec_id", "label", F.lit("").alias("code"),
                                      F.lit(0).cast("long").alias("error")), np.zeros((0, 0, 0)))
    kept = read.filter(F.size("vector") == least[0])
    books = _start(kept, entries, parts)
    salts = max(1, -(-kept.count() // owned))
    resident = _owned(_members(kept, books, salts))
    books = _updated(books, resident)
    for _ in range(rounds - 1):
        judged = written(_reassigned(resident, books))
        resident = judged.filter("NOT moved").union(_owned(judged.filter("moved")))
        books = _updated(books, resident)

    # eight entries to a long, the first in the highest byte
    words = -(-parts // 8)
    at = F.expr("shiftleft(CAST(entry AS BIGINT), 56 - 8 * (position % 8))")
    coded = _codes(resident, books).groupBy("row").agg(
        F.sum("distance").alias("error"),
        *(F.bit_or(F.when(F.floor(F.col("position") / 8) == k, at).otherwise(0)).alias(f"word{k}")
          for k in range(words)))
    digits = F.concat(*(F.lpad(F.hex(f"word{k}"), 16, "0") for k in range(words)))
    coded = coded.select("row", F.lower(F.substring(digits, 1, 2 * parts)).alias("code"), "error")
    return _described(kept.select("row", "vec_id", "label").join(coded, "row"), books)


def _described(coded: DataFrame, books: np.ndarray) -> DataFrame:
    """The result from row, vec_id, label, code and error."""
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    most = F.lit((1 << 63) - 1)
    of_label = coded.groupBy(F.col("label").alias("of_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(19,0)")), most.cast("decimal(29,0)"))
        .cast("long").alias("label_error"))
    return coded.join(of_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
           scale: int = SCALE) -> str:
    """The query op12_vector_codes in DuckDB's SQL."""
    def assigned(name: str, book: str) -> str:
        return f"""{name} AS (SELECT id, m.p, any_value(m.x) AS x, min(struct_pack(
  d := list_sum(list_transform(list_zip(m.x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))),
  e := e)) AS best FROM m JOIN {book} b ON m.p = b.p GROUP BY id, m.p)"""

    def updated(name: str, told: str, book: str) -> str:
        return f"""{name}s AS (SELECT p, e, k, sum(y) AS s, count(*) AS n FROM (SELECT p, best.e AS e,
  unnest(x) AS y, unnest(range(len(x))) AS k FROM {told}) GROUP BY p, e, k),
{name} AS (SELECT b.p, b.e, coalesce(f.c, b.c) AS c FROM {book} b LEFT JOIN (SELECT p, e,
  list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY k) AS c FROM {name}s GROUP BY p, e) f
  ON f.p = b.p AND f.e = b.e)"""

    steps = []
    for r in range(rounds):
        steps += [assigned(f"a{r}", f"b{r}"), updated(f"b{r + 1}", f"a{r}", f"b{r}")]
    steps.append(assigned(f"a{rounds}", f"b{rounds}"))
    chain = ",\n".join(steps)
    return f"""
WITH v AS (SELECT row_number() OVER () AS id, vec_id, label,
  list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
m AS (SELECT id, vec_id, p, q[p * len(q) // {parts} + 1:(p + 1) * len(q) // {parts}] AS x
  FROM v, range({parts}) t(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM m
  WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT {entries})),
{chain},
done AS (SELECT id, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code,
  sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY id),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest
  FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  digest AS codebooks_sha256 FROM v JOIN done USING (id), book"""
