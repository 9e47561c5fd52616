"""Packing: token ids, pieces, places in sequences, and the search."""

import itertools
import zlib

import numpy as np
import odd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetpulse.llm import packing

FILE = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def exact(text):
    return FILE.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_tokenizers(text):
    assert packing.encoder(packing.TOKENIZER)(text).tolist() == exact(text)


@pytest.mark.parametrize("text", ["", " ", "  a  b\n\n c\t", "it's they'll I'D", "<|endoftext|>x",
                                  "x" * 3000, " " * 3000, "1234567 89", "naïve a\x85b\x1cc",
                                  "퟿\U0010ffff", "日本語 テキスト"])
def test_ids_of_odd_texts(text):
    assert packing.encoder(packing.TOKENIZER)(text).tolist() == exact(text)


@pytest.mark.parametrize("space", [" ", "\n", " \n"])
@pytest.mark.parametrize("length", [1_000_000, 2_000_000])
def test_ids_of_long_space_runs(space, length):
    for text in ("a" + space * (length // len(space)) + "b", space * (length // len(space))):
        assert packing.encoder(packing.TOKENIZER)(text).tolist() == exact(text)


def test_pieces_of_a_long_space_run(spark):
    docs = spark.createDataFrame([(1, "a" + " " * 1_000_000 + "b"), (2, "c")],
                                 "doc_id long, text string")
    assert {r.doc_id: r.n for r in packing.pieces(docs).groupBy("doc_id").agg(
        odd.F.sum("length").alias("n")).collect()} == {1: 1_000_002, 2: 2}


def test_pieces_and_places(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").unionByName(
        odd.odd_documents(spark).filter("doc_id NOT IN (9)").withColumn(
            "doc_id", odd.F.col("doc_id") + 100_000))
    texts = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id is not None}
    rows = packing.pack(docs, group_items=100).collect()
    found = {(r.doc_id, r.piece): r for r in rows if r.doc_id is not None}
    want = {}
    for doc, text in texts.items():
        ids = [*exact(text), 0]
        cut = (len(ids) - 1) % 2048 + 1
        ends = range(cut, len(ids) + 1, 2048)
        for piece, end in enumerate(ends):
            begin = ends[piece - 1] if piece else 0
            raw = np.array(ids[begin:end], dtype="<u4").tobytes()
            want[doc, piece] = begin, end - begin, zlib.crc32(raw)
    assert {k: (r.start, r.length, r.ids_crc32) for k, r in found.items()} == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        end = 0
        for begin, length in sorted(spans):
            assert begin == end
            end += length
        assert end <= 2048


def test_few_sequences(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs).collect()
    least = -(-sum(r.length for r in rows) // 2048)
    assert len({r.sequence_id for r in rows}) <= least + 1


def test_search_empties_bins():
    """A start that wastes a bin, which exchanges can save."""
    sizes = np.array([6, 4, 5, 5, 3, 7])
    search = packing.Search(sizes, [[0, 4], [1, 2], [3], [5]], 10)
    place = search.run()
    fills = np.bincount(place, weights=sizes)
    assert sorted(fills[fills > 0].tolist()) == [10, 10, 10]


@pytest.mark.parametrize("seed", range(12))
def test_search_never_worsens(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 101, rng.integers(1, 300))
    start = packing.best_fit(sizes, 100)
    place = packing.pack_group(sizes, 100)
    fills = np.bincount(place, weights=sizes)
    assert fills.max() <= 100 and fills.sum() == sizes.sum()
    assert (fills > 0).sum() <= len(start)


@pytest.mark.parametrize("low,high,most", [(600, 760, 1.03), (450, 560, 1.02), (640, 730, 1.06)])
def test_hard_sizes(low, high, most):
    """Lengths in a narrow band around a part of the capacity, where best fit wastes much."""
    sizes = np.random.default_rng(low).integers(low, high + 1, 2_000)
    place = packing.pack_group(sizes)
    fills = np.bincount(place, weights=sizes)
    used = np.count_nonzero(fills)
    assert fills.max() <= packing.CAPACITY
    assert used <= 0.96 * len(packing.best_fit(sizes, packing.CAPACITY))
    assert used <= most * sizes.sum() / packing.CAPACITY


def test_search_ends_where_no_exchange_helps():
    """Of every pair of underfull bins, no move, one for one or two for one raises the squares."""
    sizes = np.random.default_rng(3).integers(20, 45, 60)
    capacity = 100
    place = packing.pack_group(sizes, capacity)
    fill = np.bincount(place, weights=sizes, minlength=place.max() + 1).astype(int)
    if np.count_nonzero(fill) == -(-int(sizes.sum()) // capacity):
        return
    bins = [sizes[place == b] for b in range(len(fill))]
    open_bins = [b for b in range(len(fill)) if 0 < fill[b] < capacity]
    for a in open_bins:
        outs = [(x,) for x in bins[a]] + list(itertools.combinations(bins[a], 2))
        for b in open_bins:
            if a == b:
                continue
            for out in outs:
                for into in [0, *bins[b]] if len(out) == 1 else bins[b]:
                    gained = sum(out) - into
                    fits = 0 < gained <= capacity - fill[b]
                    assert not fits or fill[b] + gained <= fill[a]
