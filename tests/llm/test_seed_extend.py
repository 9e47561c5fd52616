"""Seed and extend over words against every window of every text."""

import hashlib
import random
import re
from collections import Counter

import odd
import oracle
import pytest

from fleetpulse.llm import seed_extend
from fleetpulse.llm.queries import ORACLES, REGISTRY

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def gone_of(rows, length):
    texts = [(doc, re.findall(r"[^\x20\x09-\x0D]+", text or "")) for doc, text in rows]
    counts = Counter(tuple(w[i:i + length]) for _, w in texts for i in range(len(w) - length + 1))
    for doc, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            if counts[tuple(words[i:i + length])] > 1:
                gone[i:i + length] = [True] * length
        yield doc, words, gone


def brute(rows, length):
    out = []
    for doc, words, gone in gone_of(rows, length):
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def documents(spark, sf_dir):
    r = random.Random(4)
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    phrase = " ".join(f"p{i}" for i in range(40))
    made = [" ".join(r.choice("ab") for _ in range(r.randrange(300))) for _ in range(30)]
    made += ["a " * 36, "b " * 35, "x" * 5000 + " " + "q " * 40, "x" * 5000 + " " + "q " * 34]
    # one phrase in very many texts, with other words around it
    made += [f"u{i} v{i} {phrase} w{i} " + " ".join(f"{i}_{k}" for k in range(50))
             for i in range(150)]
    return table.unionByName(odd.odd_documents(spark).select("doc_id", "text")).unionByName(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate(made)], table.schema))


@pytest.mark.parametrize("length,seed,group,bucket", [
    (35, 12, seed_extend.GROUP_BYTES, seed_extend.BUCKET_BYTES), (35, 12, 20_000, 50_000),
    (5, 2, 30_000, 30_000), (9, 9, 50_000, 20_000)])
def test_every_window(spark, sf_dir, length, seed, group, bucket):
    docs = documents(spark, sf_dir).cache()
    want = brute([tuple(r) for r in docs.collect()], length)
    got = seed_extend.dedup(odd.with_extra(docs), length, seed, group, bucket)
    assert odd.rows(got, *COLUMNS) == want
    assert sum(r[2] for r in want) > 1000


def test_spans_are_what_goes(spark, sf_dir):
    docs = documents(spark, sf_dir).filter("doc_id >= 5000").cache()
    want = set()
    for doc, _, gone in gone_of([tuple(r) for r in docs.collect()], 35):
        edges = [i for i, (x, y) in enumerate(zip([False, *gone], [*gone, False])) if x != y]
        want |= {(doc, a, b) for a, b in zip(edges[::2], edges[1::2])}
    assert {tuple(r) for r in seed_extend.repeats(docs, group_bytes=9_000).collect()} == want


def test_empty(spark, sf_dir):
    empty = documents(spark, sf_dir).limit(0)
    assert seed_extend.dedup(empty).count() == 0
    assert seed_extend.repeats(empty).count() == 0


def test_sql(spark, sf_dir):
    name = "op13_seed_extend"
    assert oracle.compare(spark, oracle.connect(sf_dir), REGISTRY[name], ORACLES[name],
                          sf_dir) is None
