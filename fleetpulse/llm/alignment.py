"""Cross-tokenizer alignment (operator 11) by interval coalescing.

Tokenizer A (a byte-level BPE file) reads a space and the text, tokenizer B (a piece model that puts a
space ahead itself) reads the text, so the tokens of both tile the same bytes. All tokens of a slice of
texts are lexsorted by start; with the running maximum of their ends a group breaks where a start
reaches that maximum, and within a group A and B tokens are expanded into their overlaps. The overlaps
that end together are links.

Texts are taken in slices cut between a character that is not white space and a space. No token of
either vocabulary crosses such a place (``Pair`` checks that of B's), so a text of any length is
aligned in bounded memory, and the ids of a word are looked up once for each worker as long as they
stay in a bounded store.

How often a pair of ids is linked in the corpus is counted per block of texts first: a block holds its
distinct pairs once, its texts hold their places. Blocks meet in one grouped sum by pair, and each
block gets the counts of its own pairs back, so no table of all pairs is ever sent to all tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import written
from fleetpulse.llm.packing import Encoder

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
#: Characters of text whose tokens are aligned in one step, and those of a block of texts.
SLICE_CHARS, BLOCK_CHARS = 1 << 18, 4 << 20
#: Characters of words whose ids a worker keeps before it begins anew.
KEPT_CHARS = 2 << 20
#: Characters of new words that are encoded as one text.
JOINED_CHARS = 1 << 14

_CUT = re.compile(r"(?<=\S)(?= )")
_ODD = re.compile(r"\s ")
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_WRITTEN = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
            "groups_sha256 string, places array<int>, pairs array<long>, counts array<long>")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
           "count_sum long, groups_sha256 string")


def coalesce(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray,
             ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group number of every A and every B interval; both sides are in order of their starts.

    A group ends where no interval of either side goes on. Empty intervals belong to the group that
    is open at their place or begins there.
    """
    starts, ends = np.r_[starts_a, starts_b], np.r_[ends_a, ends_b]
    side = np.zeros(len(starts), dtype="int8")
    side[len(starts_a):] = 1
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order]) if len(order) else ends
    breaks = np.ones(len(order), dtype=bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), dtype="int64")
    group[order] = np.cumsum(breaks) - 1
    return group[:len(starts_a)], group[len(starts_a):]


def overlaps(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray,
             ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B intervals of every overlap, within groups expanded from A's side.

    Intervals of one side are in order and don't overlap each other.
    """
    first = np.searchsorted(ends_b, starts_a, "right")
    count = np.maximum(np.searchsorted(starts_b, ends_a, "left") - first, 0)
    a = np.repeat(np.arange(len(starts_a)), count)
    b = np.arange(len(a)) - np.repeat(np.cumsum(count) - count - first, count)
    return a, b


def segments(text: str, chars: int = SLICE_CHARS) -> Iterator[list[str]]:
    """A space and ``text`` in lists of neighbouring words of some ``chars`` characters.

    A word begins with a space that follows a character other than white space.
    """
    text = " " + text
    begin = 0
    while begin < len(text):
        end = begin + chars
        while end < len(text) and not (text[end] == " " and not text[end - 1].isspace()):
            end = text.find(" ", end + 1)
            end = end if end >= 0 else len(text)
        part = text[begin:end]
        begin = end
        if _ODD.search(part):
            yield _CUT.split(part)
        else:
            yield [" " + word for word in part.split(" ")[1:]]


class _Growing:
    """An array that is added to."""

    def __init__(self, kind: str, *first: int):
        self.held, self.size = np.array(first, dtype=kind), len(first)

    def __len__(self) -> int:
        return self.size

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.held):
            self.held = np.resize(self.held, max(2 * end, 1 << 12))
        self.held[self.size:end] = more
        self.size = end

    def filled(self) -> np.ndarray:
        return self.held[:self.size]


class Pair:
    """Ids and byte lengths of words under both tokenizers, and the text form of ids."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Encoder(path_a)
        self.a.exact.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", piece) for piece in pieces):
            raise ValueError("a piece of the model goes on behind a word's end")
        self.bytes_b = [bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i)
                        else piece.replace("▁", " ").encode()
                        for i, piece in enumerate(pieces)]
        size_a = self.a.exact.get_vocab_size()
        self.length_a = np.zeros(size_a, dtype="int64")
        for i in range(size_a):
            name = self.a.exact.id_to_token(i) or ""
            self.length_a[i] = len(name.encode()) if name in self.a.special else len(name)
        self.length_b = np.array([len(x) for x in self.bytes_b], dtype="int64")
        # ids with what follows them: another of the same side, or the group's next part
        self.names = np.array([f"{i}{end}" for end in (",", "|") for i in range(size_a)]
                              + [f"{i}{end}" for end in (",", ";") for i in range(len(pieces))],
                              dtype=object)
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.chars = 0
        self.ids = [_Growing("int32"), _Growing("int32")]
        self.ends = [_Growing("int64", 0), _Growing("int64", 0)]
        self.good = _Growing("bool")

    def _ids(self, side: int, text: str) -> np.ndarray:
        if side and text == " ":  # a text's last space alone; B puts no space ahead of nothing
            return np.array([self.b.piece_to_id("▁")], dtype="int64")
        if side:
            return np.array(self.b.encode(text[1:]), dtype="int64")
        try:
            return self.a.fast.encode_to_numpy(text, disallowed_special=()).astype("int64")
        except ValueError:  # its pattern's stack is bounded
            return np.array(self.a.exact.encode(text, add_special_tokens=False).ids, dtype="int64")

    def _keep(self, words: list[str]) -> None:
        """Encode words that follow one another as one text, and cut its ids at their ends."""
        text = "".join(words)
        sizes = np.cumsum([len(w.encode()) for w in words])
        found = [self._ids(side, text) for side in (0, 1)]
        spelled = b"".join([self.bytes_b[i] for i in found[1].tolist()]) == text.encode()
        if not spelled and len(words) > 1:
            for word in words:
                self._keep([word])
            return
        for side, (ids, lengths) in enumerate(zip(found, (self.length_a, self.length_b))):
            ends = np.searchsorted(np.cumsum(lengths[ids]), sizes) + 1 if spelled else [len(ids)]
            self.ends[side].add(np.asarray(ends) + len(self.ids[side]))
            self.ids[side].add(ids)
        self.good.add(np.full(len(words), spelled))
        for word in words:
            self.number[word] = len(self.number)
        self.chars += len(text)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of words in the store, after those not yet in it are encoded."""
        if self.chars > KEPT_CHARS:
            self.forget()
        found = list(map(self.number.get, words))
        if None not in found:
            return np.array(found, dtype="int64")
        run, chars = [], 0
        for word in dict.fromkeys(w for w, n in zip(words, found) if n is None):
            if word[-1].isspace():  # another word right behind it would change its tokens
                self._keep([word])
                continue
            run.append(word)
            chars += len(word)
            if chars > JOINED_CHARS:
                self._keep(run)
                run, chars = [], 0
        if run:
            self._keep(run)
        number = self.number
        return np.array([number[w] if n is None else n for w, n in zip(words, found)],
                        dtype="int64")

    def tokens(self, side: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and the count of each word's."""
        ends = self.ends[side].filled()
        begin = ends[numbers]
        count = ends[numbers + 1] - begin
        at = np.arange(int(count.sum())) + np.repeat(begin - (np.cumsum(count) - count), count)
        return self.ids[side].filled()[at], count


@cache
def pair_of(a: str, b: str) -> Pair:
    import public_tokenizers
    return Pair(public_tokenizers.path(a), public_tokenizers.path(b))


class Slice:
    """The words of some texts, aligned: groups and links with the text each belongs to."""

    def __init__(self, pair: Pair, rows: np.ndarray, numbers: np.ndarray):
        ids_a, count_a = pair.tokens(0, numbers)
        ids_b, count_b = pair.tokens(1, numbers)
        self.a, self.b = ids_a, ids_b
        ends_a = np.cumsum(pair.length_a[ids_a])
        ends_b = np.cumsum(pair.length_b[ids_b])
        self.starts_a, self.ends_a = ends_a - pair.length_a[ids_a], ends_a
        self.starts_b, self.ends_b = ends_b - pair.length_b[ids_b], ends_b
        self.rows_a, self.rows_b = np.repeat(rows, count_a), np.repeat(rows, count_b)
        self.group_a, self.group_b = coalesce(self.starts_a, ends_a, self.starts_b, ends_b)
        self.met_a, self.met_b = overlaps(self.starts_a, ends_a, self.starts_b, ends_b)
        self.pair = pair

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and id pair of every link: of the overlaps those that end together."""
        both = self.ends_a[self.met_a] == self.ends_b[self.met_b]
        a, b = self.met_a[both], self.met_b[both]
        return self.rows_a[a], self.b[b].astype("int64") << 32 | self.a[a]

    def first_rows(self) -> np.ndarray:
        """The row of every group."""
        first = np.ones(len(self.group_a), dtype=bool)
        first[1:] = self.group_a[1:] != self.group_a[:-1]
        return self.rows_a[first]

    def described(self) -> tuple[np.ndarray, np.ndarray]:
        """The text parts of all groups in order, each with what follows it, and their rows."""
        last_a = np.r_[self.group_a[1:] != self.group_a[:-1], True]
        last_b = np.r_[self.group_b[1:] != self.group_b[:-1], True]
        size_a, size_b = len(self.pair.length_a), len(self.pair.length_b)
        code_a = self.a + size_a * last_a
        code_b = self.b + 2 * size_a + size_b * last_b
        groups = int(self.group_a[-1]) + 1
        before_b = np.r_[0, np.cumsum(np.bincount(self.group_b, minlength=groups))]
        to_a = np.cumsum(np.bincount(self.group_a, minlength=groups))
        out = np.empty(len(code_a) + len(code_b), dtype="int64")
        rows = np.empty(len(out), dtype="int64")
        at_a = np.arange(len(code_a)) + before_b[self.group_a]
        at_b = np.arange(len(code_b)) + to_a[self.group_b]
        out[at_a], out[at_b] = code_a, code_b
        rows[at_a], rows[at_b] = self.rows_a, self.rows_b
        return self.pair.names[out], rows


class _Block:
    """What is gathered of the texts of a block."""

    def __init__(self, number: int, slice_chars: int):
        self.number, self.slice_chars = number, slice_chars
        self.docs: list[int | None] = []
        self.counts: list[np.ndarray] = []
        self.digests: list = []
        self.bad: list[bool] = []
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self.chars = 0
        self.waiting: list[list[str]] = []
        self.owners: list[int] = []
        self.waiting_chars = 0

    def open(self, doc: int | None) -> None:
        self.docs.append(doc)
        self.counts.append(np.zeros(4, dtype="int64"))
        self.digests.append(None)
        self.bad.append(False)

    def take(self, pair: Pair, words: list[str]) -> None:
        self.waiting.append(words)
        self.owners.append(len(self.docs) - 1)
        self.waiting_chars += sum(map(len, words))
        if self.waiting_chars >= self.slice_chars:
            self.settle(pair)

    def settle(self, pair: Pair) -> None:
        """Align the words that wait."""
        if not self.waiting:
            return
        numbers = pair.numbers([w for words in self.waiting for w in words])
        rows = np.repeat(self.owners, [len(words) for words in self.waiting])
        good = pair.good.filled()[numbers]
        for row in np.unique(rows[~good]):
            self.bad[row] = True
        kept = ~np.asarray(self.bad)[rows]
        if kept.any():
            part = Slice(pair, rows[kept], numbers[kept])
            linked, pairs = part.linked()
            self.links.append((linked, pairs))
            n = len(self.docs)
            first = min(self.owners)
            for place, of in enumerate((part.rows_a, part.rows_b, part.first_rows(), linked)):
                for row, count in enumerate(np.bincount(of - first, minlength=n - first)):
                    self.counts[first + row][place] += count
            names, of = part.described()
            edges = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            for begin, end in zip(edges, [*edges[1:], len(of)]):
                row = of[begin]
                if self.digests[row] is None:
                    self.digests[row] = [hashlib.sha256(), ""]
                digest, tail = self.digests[row]
                told = tail + "".join(names[begin:end].tolist())
                digest.update(told[:-1].encode())  # the last group has no mark behind it
                self.digests[row][1] = told[-1]
        self.chars += self.waiting_chars
        self.waiting, self.owners, self.waiting_chars = [], [], 0

    def batch(self) -> pa.RecordBatch:
        """A row for each text, then one for the block with its distinct pairs and their counts."""
        bad = np.asarray(self.bad, dtype=bool)
        n = len(self.docs)
        counts = np.where(bad[:, None], 0, np.array(self.counts).reshape(n, 4))
        rows = np.concatenate([x[0] for x in self.links] or [np.empty(0, "int64")])
        pairs = np.concatenate([x[1] for x in self.links] or [np.empty(0, "int64")])
        pairs, rows = pairs[~bad[rows]], rows[~bad[rows]]
        places, distinct = pd.factorize(pairs)
        often = np.bincount(places, minlength=len(distinct))
        offsets = np.searchsorted(rows, np.arange(n + 1)).astype("int32")
        digests = ["" if b or d is None else d[0].hexdigest() for b, d in zip(bad, self.digests)]
        one = pa.array([0, len(distinct)], pa.int32())
        docs = [pa.array([self.number] * n, pa.int64()), pa.array(self.docs, pa.int64()),
                *(pa.array(counts[:, k]) for k in range(4)), pa.array(digests, pa.string()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.astype("int32"))),
                pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))]
        own = [pa.array([self.number], pa.int64()), *(pa.nulls(1, pa.int64()) for _ in range(5)),
               pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())),
               pa.ListArray.from_arrays(one, pa.array(distinct)),
               pa.ListArray.from_arrays(one, pa.array(often))]
        names = ["block", "doc_id", *_COUNTS, "groups_sha256", "places", "pairs", "counts"]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([x.cast(y.type), y]) for x, y in zip(docs, own)], names=names)


def _aligned(docs: DataFrame, a: str, b: str, slice_chars: int, block_chars: int) -> DataFrame:
    """A row for each text and for each block, see ``_Block.batch``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        number = TaskContext.get().partitionId() << 32
        block = _Block(number, slice_chars)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.open(doc)
                text = text.as_py()
                for words in segments(text, slice_chars) if text else ():
                    block.take(pair, words)
                if block.chars + block.waiting_chars >= block_chars:
                    block.settle(pair)
                    yield block.batch()
                    number += 1
                    block = _Block(number, slice_chars)
        if block.docs:
            block.settle(pair)
            yield block.batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, _WRITTEN)


def _finish(left: pa.Table, right: pa.Table) -> pa.Table:
    """The texts of a block with what the corpus says of its pairs."""
    n = left.num_rows
    at = right["place"].to_numpy()
    size = int(at.max()) + 1 if len(at) else 0
    often, best = np.zeros(size, dtype="int64"), np.zeros(size, dtype="int64")
    often[at], best[at] = right["n"].to_numpy(), right["best"].to_numpy(zero_copy_only=False)
    lists = left["places"].combine_chunks()
    lists = lists if isinstance(lists, pa.ListArray) else pa.concat_arrays(lists.chunks)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py() if n else np.zeros(1, "int64")
    places = lists.flatten().to_numpy() if n else np.empty(0, "int64")
    sums = [pa.array(np.diff(np.r_[0, np.cumsum(x[places])][offsets])) for x in (best, often)]
    return pa.Table.from_arrays(
        [left["doc_id"], *(left[c] for c in _COUNTS), *sums, left["groups_sha256"]],
        names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])


def pair_counts(told: DataFrame) -> DataFrame:
    """pair, n (its links in the corpus), best (no pair of its B id has more)."""
    counts = told.groupBy("pair").agg(F.sum("n").alias("n"))
    top = counts.groupBy(F.shiftright("pair", 32).alias("b")).agg(F.max("n").alias("top"))
    return (counts.join(top, F.shiftright("pair", 32) == F.col("b"))
            .select("pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best")))


def align(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B,
          slice_chars: int = SLICE_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256.

    A link is an overlap of an A and a B token that end together; ``n_best`` counts the links whose
    id pair is linked as often as any pair of its B id, ``count_sum`` adds up their counts in the
    corpus. Null and empty texts, and texts that the joined tokens don't spell (a text with U+2581,
    which B reads as a space), have no tokens: all numbers are 0 and the digest is ''. Texts of any
    length are aligned whole, slice by slice. Repeated rows and rows with a null doc_id are rows of
    their own, and all count. Other columns are not read; an empty table gives no rows.
    """
    found = written(_aligned(docs, a, b, slice_chars, block_chars))
    told = found.filter("pairs IS NOT NULL").select(
        "block", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "of")).select(
        "block", "place", F.col("of.pairs").alias("pair"), F.col("of.counts").alias("n"))
    replies = told.drop("n").join(pair_counts(told), "pair").select(
        F.col("block").alias("to_block"), "place", "n", "best")
    texts = found.filter("pairs IS NULL").drop("pairs", "counts")
    return texts.groupBy("block").cogroup(
        replies.groupBy("to_block")).applyInArrow(_finish, _RESULT)


def groups(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """The groups themselves: doc_id, start and end byte (the space ahead is byte 0), and the ids.

    One row for each group with ``a`` and ``b`` as arrays. Texts without tokens (see ``align``) give
    no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(a, b)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                found = map(pair.numbers, segments(text))
                if not all(pair.good.filled()[numbers].all() for numbers in found):
                    continue
                begun = 0
                for words in segments(text):
                    numbers = pair.numbers(words)
                    part = Slice(pair, np.zeros(len(numbers), dtype="int64"), numbers)
                    n = int(part.group_a[-1]) + 1
                    cut_a = np.searchsorted(part.group_a, np.arange(n + 1)).astype("int32")
                    cut_b = np.searchsorted(part.group_b, np.arange(n + 1)).astype("int32")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * n, pa.int64()),
                         pa.array(part.starts_a[cut_a[:-1]] + begun),
                         pa.array(part.ends_a[cut_a[1:] - 1] + begun),
                         pa.ListArray.from_arrays(pa.array(cut_a), pa.array(part.a.astype("int32"))),
                         pa.ListArray.from_arrays(pa.array(cut_b), pa.array(part.b.astype("int32")))],
                        names=["doc_id", "start", "end", "a", "b"])
                    begun += int(part.ends_a[-1])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, start long, end long, a array<int>, b array<int>")
