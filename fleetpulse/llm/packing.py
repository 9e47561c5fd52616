"""Best-fit packing (operator 9) into sequences of a fixed number of tokens by local search.

Texts are tokenized where they are read. Only the short pieces are packed: they are dealt at random to
groups of bounded size, and each group is packed on its own: a best-fit start, then a search that
exchanges documents between underfull bins (one for one, two for one, or a move) whenever this raises
the sum of squared fills, which drains the emptiest bins until they are empty.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import steps
from fleetpulse.llm.common import checkpoint

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 2048
END_ID = 0
#: Pieces that one task packs together; larger groups waste less, smaller ones spread further.
GROUP_ITEMS = 16_384

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


class Encoder:
    """Token ids of a tokenizer file, through a faster engine with the same vocabulary.

    The file is a byte-level BPE whose ids rank its merges, so its tokens are the ranks that the
    other engine needs. Texts with a special token's name go through the file's own engine, which
    reads them as that token, and so do texts that the other engine can't take, such as those with
    a run of a million white-space characters.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.special = [t["content"] for t in described["added_tokens"]]
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i
                 for token, i in described["model"]["vocab"].items() if token not in self.special}
        import public_tokenizers
        self.fast = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN,
                                      mergeable_ranks=ranks, special_tokens={})
        self.exact = Tokenizer.from_file(path)

    def __call__(self, text: str) -> np.ndarray:
        if not any(name in text for name in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype(
                    "<u4", copy=False)
            except ValueError:  # its pattern's stack is bounded
                pass
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    letters.update({chr(256 + i): b for i, b in enumerate(rest)})
    return letters


@cache
def encoder(name: str) -> Encoder:
    import public_tokenizers
    return Encoder(public_tokenizers.path(name))


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
           id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids_crc32.

    A document is its token ids and an end id; a null or empty text has the end id only. One longer
    than ``capacity`` is cut so that all its pieces but the first are full.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in steps(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.array([END_ID], dtype="<u4"))
                n = len(ids)
                ends = range((n - 1) % capacity + 1, n + 1, capacity)
                for piece, end in enumerate(ends):
                    begin = ends[piece - 1] if piece else 0
                    rows.append((doc, piece, begin, end - begin, zlib.crc32(ids[begin:end])))
            columns = list(zip(*rows))
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_column}`").alias("text"))
    return read.mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest item first, each into the fullest bin that has room."""
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins: list[list[int]] = []
    open_gaps = 0  # bit g: there is a bin with gap g
    for item in np.argsort(-sizes, kind="stable"):
        size = int(sizes[item])
        fitting = open_gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            place = by_gap[gap].pop()
            if not by_gap[gap]:
                open_gaps &= ~(1 << gap)
        else:
            gap, place = capacity, len(bins)
            bins.append([])
        bins[place].append(int(item))
        if gap > size:
            by_gap[gap - size].append(place)
            open_gaps |= 1 << (gap - size)
    return bins


class Search:
    """Exchanges between underfull bins that raise the sum of squared fills.

    Taking ``d`` tokens from a bin with fill ``a`` into one with fill ``b`` raises it if
    ``b + d > a``, so tokens flow from emptier to fuller bins and the search ends.
    """

    def __init__(self, sizes: np.ndarray, bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes.astype("int64"), capacity
        self.bin_of = np.empty(len(sizes), dtype="int64")
        for place, items in enumerate(bins):
            self.bin_of[items] = place
        self.fill = np.bincount(self.bin_of, weights=sizes, minlength=len(bins)).astype("int64")

    def exchange(self, out: np.ndarray, into: np.ndarray, source: int, target: int) -> None:
        moved = self.sizes[out].sum() - self.sizes[into].sum()
        self.bin_of[out], self.bin_of[into] = target, source
        self.fill[source] -= moved
        self.fill[target] += moved

    def better(self, source: int, deltas: np.ndarray, targets: np.ndarray) -> int:
        """The exchange with the largest gain, or -1."""
        fill = self.fill[targets]
        gain = deltas * (fill + deltas - self.fill[source])
        gain[(deltas <= 0) | (fill + deltas > self.capacity) | (targets == source)] = 0
        best = int(np.argmax(gain)) if len(gain) else -1
        return best if best >= 0 and gain[best] > 0 else -1

    def improve(self, source: int, underfull: np.ndarray, others: np.ndarray) -> bool:
        """One exchange that drains ``source``; False if there is none.

        Pieces of equal length are worth the same, so each length of the bin is tried once, alone
        and with every other.
        """
        own = np.flatnonzero(self.bin_of == source)
        lengths, first = np.unique(-self.sizes[own], return_index=True)
        alone = own[first]
        none = np.empty(0, dtype="int64")
        for item in alone:  # a move
            best = self.better(source, np.full(len(underfull), self.sizes[item]), underfull)
            if best >= 0:
                self.exchange(np.array([item]), none, source, underfull[best])
                return True
        often = np.bincount(np.searchsorted(lengths, -self.sizes[own]))
        seconds = {i: own[self.sizes[own] == -lengths[i]][1] for i in np.flatnonzero(often > 1)}
        pairs = [(a, b) for i, a in enumerate(alone) for b in alone[i + 1:]]
        pairs += [(alone[i], again) for i, again in seconds.items()]
        lengths_of, bins_of = self.sizes[others], self.bin_of[others]
        for out in [*((x,) for x in alone), *pairs]:  # one for one, two for one
            out = np.array(out)
            best = self.better(source, self.sizes[out].sum() - lengths_of, bins_of)
            if best >= 0:
                self.exchange(out, others[best:best + 1], source, bins_of[best])
                return True
        return False

    def run(self) -> np.ndarray:
        """Drain bins, the emptiest first, again and again; the bin of every item at the end.

        Ends when no underfull bin has an exchange left, or when no packing has fewer bins. Every
        exchange raises the sum of squared fills, so there is an end.
        """
        floor = -(-int(self.sizes.sum()) // self.capacity)
        better = True
        while better:
            better = False
            for source in np.argsort(self.fill, kind="stable"):
                if np.count_nonzero(self.fill) <= floor:
                    return self.bin_of
                while 0 < self.fill[source] < self.capacity:
                    underfull = np.flatnonzero((self.fill > 0) & (self.fill < self.capacity))
                    others = np.flatnonzero((self.fill < self.capacity)[self.bin_of]
                                            & (self.bin_of != source))
                    if not self.improve(source, underfull, others):
                        break
                    better = True
        return self.bin_of


def pack_group(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The bin of every item of one group; every size is at most ``capacity``."""
    return Search(sizes, best_fit(sizes, capacity), capacity).run()


def _pack(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ignore_index=True)
    place = pack_group(pdf["length"].to_numpy(), capacity)
    order = np.argsort(place, kind="stable")
    pdf, place = pdf.iloc[order], place[order]
    length = pdf["length"].to_numpy()
    begin = np.cumsum(length) - length
    first = np.r_[True, place[1:] != place[:-1]]
    pdf["offset"] = begin - np.maximum.accumulate(np.where(first, begin, 0))
    pdf["sequence_id"] = (pdf["grp"].to_numpy() << 24) + place
    return pdf.drop(columns="grp")


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY,
         group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per piece of every document, with its ``sequence_id`` and ``offset``.

    Null and empty texts are pieces of one token. Repeated rows are packed as rows of their own. An
    empty table gives no rows. Of the input's columns only ``doc_id`` and ``text`` are read.
    """
    cut = checkpoint(pieces(docs, tokenizer, capacity))
    full = cut.filter(F.col("length") == capacity)
    short = cut.filter(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_items))
    columns = [*cut.columns, "sequence_id", "offset"]
    # rows are told apart by their place in the written table, so that copies spread too
    deal: Column = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    packed = (short.withColumn("grp", deal).groupBy("grp")
              .applyInPandas(lambda pdf: _pack(pdf, capacity)[columns],
                             f"{PIECES}, sequence_id long, offset long"))
    whole = full.withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn(
        "offset", F.lit(0).cast("long"))
    return packed.unionByName(whole)
