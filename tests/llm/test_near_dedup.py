"""Near-dedup against all pairs; BagMinHash agreement against weighted Jaccard similarity."""

import re
from collections import Counter, defaultdict

import numpy as np
import odd
import oracle
import pytest

from fleetpulse.llm import links, near_dedup
from fleetpulse.llm.queries import ORACLES, REGISTRY


def bag(text):
    words = [w for w in re.split(r"[ \t-\r]+", text or "") if w]
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else {}


def all_pairs(texts):
    """Class of every id by comparing all pairs of texts."""
    bags = {k: bag(t) for k, t in texts.items()}
    shared, parent = defaultdict(int), {k: k for k in texts}
    holders = defaultdict(list)
    for k, b in bags.items():
        for x, n in b.items():
            for other, m in holders[x]:
                shared[other, k] += min(n, m)
            holders[x].append((k, n))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k
    for (a, b), n in shared.items():
        if 9 * n >= 4 * (sum(bags[a].values()) + sum(bags[b].values())):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {k: root(k) for k in texts}


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert got == all_pairs({r.doc_id: r.text for r in docs.collect()})


def test_sql(spark, sf_dir):
    name = "op5_near_dedup"
    con = oracle.connect(sf_dir)
    assert oracle.compare(spark, con, REGISTRY[name], ORACLES[name], sf_dir) is None


def test_group_of_edited_copies(spark):
    """Copies that differ from the first text in one to seven places, many of them not linked to it."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(150)]
    texts = {0: " ".join(words)}
    for k in range(1, 160):
        changed = list(words)
        for at in rng.choice(150, rng.integers(1, 8), replace=False):
            changed[at] = f"x{rng.integers(12)}"
        texts[1000 - k] = " ".join(changed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert got == all_pairs(texts)


def edited(rng, copies, words, edits):
    """Copies of one text with words of their own at a few places."""
    text = [f"w{i}" for i in range(words)]
    out = []
    for k in range(copies):
        changed = list(text)
        for at in rng.choice(words, edits(), replace=False):
            changed[at] = f"x{k}_{at}"
        out.append(" ".join(changed))
    return out


def by_matrix(texts):
    """Classes of texts without repeated shingles, by products of an incidence matrix."""
    bags = [bag(t) for t in texts]
    number = {x: n for n, x in enumerate({x for b in bags for x in b})}
    often = Counter(x for b in bags for x in b)
    matrix = np.zeros((len(bags), len(number)), dtype="float32")
    for i, b in enumerate(bags):
        matrix[i, [number[x] for x in b if often[x] > 1]] = 1
    w = np.array([len(b) for b in bags])
    linked = 9 * (matrix @ matrix.T) >= 4 * (w[:, None] + w[None, :])
    found = np.arange(len(bags))
    while True:
        lower = np.where(linked, found[None, :], len(bags)).min(axis=1)
        lower = np.minimum(lower, found)
        if (lower == found).all():
            return found
        found = lower


@pytest.mark.parametrize("edits,tile_rows", [((4, 5), 1024), ((1, 8), 300)])
def test_two_thousand_edited_copies(spark, monkeypatch, edits, tile_rows):
    """Some are linked to nothing, though each shares most of its shingles with all: no table that
    is made on the way has more rows than a few for each band of each text."""
    rng = np.random.default_rng(11)
    texts = edited(rng, 2_000, 300, lambda: rng.integers(*edits))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    counts, plain = [], near_dedup.checkpoint

    def counted(df):
        out = plain(df)
        counts.append(out.count())
        return out

    monkeypatch.setattr(near_dedup, "checkpoint", counted)
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs, tile_rows=tile_rows).collect()}
    assert max(counts) <= 2_000 * near_dedup.BANDS
    assert got == dict(enumerate(by_matrix(texts).tolist()))


def test_overlaps(monkeypatch):
    rng = np.random.default_rng(2)
    monkeypatch.setattr(near_dedup, "COLUMNS", 7)
    bags = [np.unique(rng.integers(0, 60, rng.integers(0, 30))) for _ in range(25)]
    sides = bags[:10], bags[10:]
    flat = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in sides]
    got = near_dedup.overlaps(*flat[0], *flat[1], (10, 15))
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sides[1]] for a in sides[0]]


def test_odd_rows(spark):
    docs = odd.odd_documents(spark)
    got = near_dedup.classes(docs).collect()
    classes = {r.doc_id: r.class_id for r in got if r.doc_id is not None}
    assert classes[1] == classes[2] == 1 and classes[4] == 4 and classes[6] == 6
    assert all(r.class_id is None for r in got if r.doc_id is None)
    kept = near_dedup.keep_one(docs)
    assert kept.filter("doc_id IS NULL").count() == 2
    assert kept.filter("doc_id IN (1, 2)").count() == 1 and kept.filter("doc_id = 9").count() == 1


def test_signatures_agree_as_often_as_bags():
    rng = np.random.default_rng(1)
    size, n = 96, 60
    for overlap in (0.3, 0.6, 0.9):
        agree, similar = [], []
        for _ in range(n):
            keys = rng.integers(0, 2**63, 80).astype("uint64")
            a = rng.integers(1, 6, 80)
            b = np.where(rng.random(80) < overlap, a, rng.integers(0, 6, 80))
            rows = np.r_[np.zeros(80, dtype=int), np.ones((b > 0).sum(), dtype=int)]
            s = near_dedup.bag_minhash(np.r_[keys, keys[b > 0]], rows, np.r_[a, b[b > 0]], 2, size)
            agree.append((s[0] == s[1]).mean())
            similar.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(np.mean(agree) - np.mean(similar)) < 0.02


def test_components_of_a_long_path(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (102, 100)],
                                  "a long, b long")
    got = {r.node: r.component for r in links.components(pairs).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}
