"""Suffix dedup against every string of every text; merged order against sorted windows."""

import hashlib
from collections import Counter

import numpy as np
import odd
import pytest

from fleetpulse.llm import suffix_dedup, window_order


def brute(docs):
    texts = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    key = {i: (-1 << 63) if i is None else i for i, _ in texts}
    first = {}
    for i, raw in texts:
        for at in range(len(raw) - 49):
            s = raw[at:at + 50]
            first[s] = min(first.get(s, key[i]), key[i])
    out = []
    for i, raw in texts:
        covered = bytearray(len(raw))
        for at in range(len(raw) - 49):
            if first[raw[at:at + 50]] < key[i]:
                covered[at:at + 50] = b"\1" * 50
        spans = sum(covered[k] and not (k and covered[k - 1]) for k in range(len(raw)))
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        out.append((i, len(raw), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group_bytes, bucket_bytes, together", [
    (3 << 20, 10 << 20, 1 << 20), (20_000, 50_000, 3000)])
def test_whole_table(spark, sf_dir, monkeypatch, group_bytes, bucket_bytes, together):
    monkeypatch.setattr(suffix_dedup, "MERGED_TOGETHER", together)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert odd.rows(suffix_dedup.dedup(docs, group_bytes, bucket_bytes)) == brute(docs)


def test_odd_rows(spark):
    docs = odd.odd_documents(spark)
    assert odd.rows(suffix_dedup.dedup(docs, 2000, 3000)) == brute(docs)


def test_hot_anchors_are_spread(spark, monkeypatch, tmp_path):
    """A passage of most documents, between texts of their own: no bucket gets all its contexts."""
    rng = np.random.default_rng(5)

    def word(n):
        return "".join(rng.choice(list("abcdefghij klmnop"), n))

    passage, other = word(150), word(60)
    rows = [(i, word(70) + (passage if i % 4 else other) + word(rng.integers(0, 90)))
            for i in range(400)]
    rows += [(500 + i, rows[i][1][:200]) for i in range(0, 40, 3)] + [(7, word(90) + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    merge, folder = suffix_dedup._merge_bucket, str(tmp_path)

    def counted(table):
        import uuid
        anchors = np.concatenate([suffix_dedup._unpack(p)[0] for p in table["packed"].to_pylist()])
        with open(f"{folder}/{uuid.uuid4()}", "w") as file:
            file.write(str(np.unique(anchors, return_counts=True)[1].max()))
        return merge(table)

    monkeypatch.setattr(suffix_dedup, "_merge_bucket", counted)
    assert odd.rows(suffix_dedup.dedup(docs, 4000, 500, hot_contexts=50)) == brute(docs)
    assert max(int(f.read_text()) for f in tmp_path.iterdir()) < 150


@pytest.mark.parametrize("hot", [1, 3])
def test_hot_anchors_give_the_same(spark, sf_dir, hot):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert odd.rows(suffix_dedup.dedup(docs, 20_000, 50_000, hot)) == brute(docs)
    docs = odd.odd_documents(spark)
    assert odd.rows(suffix_dedup.dedup(docs, 2000, 3000, hot)) == brute(docs)


def test_runs_of_one_letter(spark):
    docs = spark.createDataFrame(
        [(5, "a" * 300), (2, "a" * 60), (9, "b" + "a" * 49), (7, "ab" * 80), (8, "ba" * 40),
         (3, "c" * 49), (4, "c" * 49), (1, "d" * 50), (6, "x" + "d" * 50 + "y")],
        "doc_id long, text string")
    assert odd.rows(suffix_dedup.dedup(docs, 100, 200)) == brute(docs)


@pytest.mark.parametrize("letters,copies", [(2, 1), (26, 3), (1, 0)])
def test_merged_order(letters, copies):
    """Windows with equals come back, equal ones side by side; those alone drop out."""
    rng = np.random.default_rng(letters)
    data = rng.integers(97, 97 + letters, 4000).astype("uint8")
    for k in range(copies):
        data[2000 + 400 * k:2200 + 400 * k] = data[100:300]
    first, last, anchor, at, _ = window_order.stretches(data, np.array([0, len(data)]))
    count = last - first + 1
    starts = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
    numbers = np.unique(anchor, return_inverse=True)[1]
    order, interval = window_order.merge_windows(
        data, starts, np.repeat(numbers, count), np.repeat(at, count) - starts)
    windows = [data[s:s + 50].tobytes() for s in starts]
    often = {w for w, n in Counter(windows).items() if n > 1}
    assert sorted(order.tolist()) == [i for i, w in enumerate(windows) if w in often]
    assert len(set(interval.tolist())) == len(often)
    assert len({(windows[i], n) for i, n in zip(order, interval.tolist())}) == len(often)
    assert (np.diff(interval) >= 0).all()


def test_many_anchors():
    """More anchors than one dealing tells apart."""
    rng = np.random.default_rng(1)
    data = rng.integers(97, 123, 200_000).astype("uint8")
    starts = np.arange(0, 199_000, 2)
    starts = np.r_[starts, starts]
    numbers = np.r_[np.arange(len(starts) // 2), np.arange(len(starts) // 2)]
    order, interval = window_order.merge_windows(data, starts, numbers, np.zeros(len(starts), int))
    assert len(order) == len(starts) and interval[-1] == len(starts) // 2 - 1
    assert (starts[order[::2]] == starts[order[1::2]]).all()


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    part = rng.integers(97, 123, 90).astype("uint8")
    rows = [np.concatenate([rng.integers(97, 123, n).astype("uint8"), part,
                            rng.integers(97, 123, 30).astype("uint8")]) for n in (0, 13, 57)]
    offsets = np.r_[0, np.cumsum([len(r) for r in rows])]
    data = np.concatenate(rows)
    first, last, anchor, _, row = window_order.stretches(data, offsets)
    of_window = {}
    for a, b, h in zip(first, last, anchor):
        for s in range(a, b + 1):
            of_window.setdefault(data[s:s + 50].tobytes(), set()).add(int(h))
    assert all(len(hashes) == 1 for hashes in of_window.values())
    assert (last - first + 1).sum() == sum(len(r) - 49 for r in rows)
