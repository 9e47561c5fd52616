"""Fingerprints: order, edited texts, likeness."""

import hashlib

import numpy as np
import odd

from fleetpulse.llm import digests


def plain_digest(text):
    raw = text.encode()
    counts = [0] * 256
    for i in range(len(raw) - 2):
        x = raw[i] | raw[i + 1] << 8 | raw[i + 2] << 16
        counts[(x * 2654435761 & 0xFFFFFFFF) >> 24] += 1
    ranked = sorted(counts)
    quarters = [ranked[63], ranked[127], ranked[191]]
    codes = [sum(c > q for q in quarters) for c in counts]
    head = [int(min(np.log(len(raw) + 1.0) * 10, 255)), *(
        q * 15 // max(quarters[2], 1) for q in quarters[:2])]
    body = [codes[i] | codes[i + 1] << 2 | codes[i + 2] << 4 | codes[i + 3] << 6
            for i in range(0, 256, 4)]
    return bytes(head + body).hex()


def test_digests_as_counted():
    texts = ["", "a", "ab", "abc", odd.PLAIN, "é" * 50, odd.LONG[:5000], "", "xyz"]
    got = [r.tobytes().hex() for r in digests.digest_texts(texts)]
    assert got == [plain_digest(t) for t in texts]


def test_likeness_is_bounded_and_falls():
    words = odd.LONG.split()[:400]
    texts = [" ".join(words[:400 - k] + [f"zq{i}" for i in range(k)]) for k in (0, 40, 160, 400)]
    rows = digests.digest_texts(texts)
    near = [digests.likeness(rows[:1], rows[k:k + 1])[0] for k in range(4)]
    assert near[0] == 1.0 and near == sorted(near, reverse=True) and near[-1] >= 0
    assert (digests.likeness(rows, rows[::-1]) == digests.likeness(rows[::-1], rows)).all()


def check(docs):
    rows = sorted(docs.select("doc_id", "text").distinct().collect())
    texts = [r.text or "" for r in rows]
    want = {}
    for r, text, following in zip(rows, texts, texts[1:] + texts[:1]):
        changed = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        own, other, after = digests.digest_texts([text, changed, following])
        want[r.doc_id] = (len(text), hashlib.sha256(changed.encode()).hexdigest(),
                          own.tobytes().hex(), other.tobytes().hex(),
                          digests.likeness(own[None], other[None])[0],
                          digests.likeness(own[None], after[None])[0])
    got = {r[0]: tuple(r)[1:] for r in digests.compare_edited(docs).collect()}
    assert got == want


def test_next_document_across_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check(docs)
    check(docs.repartition(7).filter("doc_id < 9"))


def test_single_document_follows_itself(spark):
    docs = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    row = digests.compare_edited(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
