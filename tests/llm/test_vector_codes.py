"""Vector codes against a plain Lloyd over lists."""

import hashlib
import math

import odd
import oracle
import pytest

from fleetpulse.llm import vector_codes
from fleetpulse.llm.queries import ORACLES, REGISTRY

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def brute(rows, parts, entries, rounds):
    kept = [(i, [max(-(1 << 26), min(1 << 26, math.floor(256 * x))) for x in v], label)
            for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    ids = sorted({i for i, _, _ in kept})[:entries]
    first = [min(v for i, v, _ in kept if i == wanted) for wanted in ids]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for v in first] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, v, _ in kept:
                members.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, xs in members.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, of_label = [], {}
    for i, v, label in kept:
        codes = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in codes)
        of_label[label] = of_label.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in codes), error, label))
    digest = hashlib.sha256(",".join(
        str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    return sorted(((i, c, e, min(of_label[label], (1 << 63) - 1), digest)
                   for i, c, e, label in out), key=repr)


def some(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in table.orderBy("vec_id").limit(120).collect()]
    plain = rows[3][1]
    return rows + [(901, None, 1), (902, [math.nan] * 64, 1), (903, [None, *plain[1:]], 2),
                   (904, [math.inf, *plain[1:]], 2), (905, plain, None), (906, [0.1] * 64, None),
                   (906, [0.1] * 64, None), (3, plain, 1), (907, [3e38, *plain[1:]], 7),
                   (908, [-3e38, *plain[1:]], 7), (909, [], 1)]


@pytest.mark.parametrize("parts,entries,rounds,owned", [(16, 64, 2, 1 << 16), (4, 9, 4, 10)])
def test_codes(spark, sf_dir, parts, entries, rounds, owned):
    rows = some(spark, sf_dir)
    docs = odd.with_extra(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = vector_codes.encode(docs, parts, entries, rounds, owned=owned)
    rows = [tuple(r) for r in docs.select("vec_id", "embedding", "label").collect()]
    assert odd.rows(got, *COLUMNS) == brute(rows, parts, entries, rounds)


def test_few_and_no_vectors(spark):
    two = spark.createDataFrame([(5, [1.0] * 16, 1), (2, [-0.001] * 16, None)], SCHEMA)
    assert [(r.vec_id, r.code, r.error) for r in vector_codes.encode(two).orderBy("vec_id").collect()
            ] == [(2, "00" * 16, 0), (5, "01" * 16, 0)]
    assert vector_codes.encode(two.limit(0)).count() == 0
    assert vector_codes.encode(two.withColumn("embedding", two.embedding.cast(
        "array<string>").cast("array<float>")).filter("vec_id < 0")).count() == 0
    # lengths that can't be cut, or differ from the least id's, are dropped; a null id is last
    mixed = spark.createDataFrame([(1, [0.5] * 17, 1), (2, [0.5] * 32, 1), (3, [0.5] * 16, 1),
                                   (None, [0.25] * 32, 1)], SCHEMA)
    got = vector_codes.encode(mixed).collect()
    assert sorted((r.vec_id or 0, r.code[:2]) for r in got) == [(0, "01"), (2, "00")]


def test_only_changed_members_move(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").selectExpr("vec_id", "embedding")
    kept = vectors.select("vec_id", vector_codes.whole_numbers("embedding", 256).alias("vector"),
                          vectors.vec_id.alias("row"))
    books = vector_codes._start(kept, 64, 16)
    resident = vector_codes._owned(vector_codes._members(kept, books, 3))
    judged = vector_codes._reassigned(resident, vector_codes._updated(books, resident))

    def members(df):
        return {(r.position, i, r.entry) for r in df.collect() for i in
                [int.from_bytes(r.ids[k:k + 8], "little") for k in range(0, len(r.ids), 8)]}

    before, stay, move = members(resident), members(judged.filter("NOT moved")), members(
        judged.filter("moved"))
    assert stay <= before and not move & before
    assert len(stay) + len(move) == len(before) == 16 * kept.count()
    assert 0 < len(move) < len(stay)


def test_sql(spark, sf_dir):
    name = "op12_vector_codes"
    assert oracle.compare(spark, oracle.connect(sf_dir), REGISTRY[name], ORACLES[name],
                          sf_dir) is None
