"""Alignment of two tokenizers against one text at a time with the files' own engines."""

import hashlib
import random
from collections import Counter

import numpy as np
import odd
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetpulse.llm import alignment

COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def byte_of():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokens(text):
    """Ids and bytes of every token of A and of B, or None if they don't spell the text."""
    a_file = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER_A))
    a_file.encode_special_tokens = True
    b_file = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path(alignment.TOKENIZER_B))
    letter = byte_of()
    a = [(i, bytes(letter[c] for c in a_file.id_to_token(i)))
         for i in a_file.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in b_file.encode(text):
        piece = b_file.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if b_file.is_byte(i)
                  else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    spelled = all(b"".join(x[1] for x in side) == want for side in (a, b))
    return (a, b) if text and spelled else ([], [])


def ends(side):
    at, out = 0, {}
    for place, (_, spelled) in enumerate(side):
        at += len(spelled)
        out[at] = place
    return out


def brute(rows):
    found, counts = [], Counter()
    for doc, text in rows:
        a, b = tokens(text or "")
        ends_a, ends_b = ends(a), ends(b)
        told, links, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            to_a, to_b = ends_a[end] + 1, ends_b[end] + 1
            told.append(",".join(str(x[0]) for x in a[i:to_a]) + "|"
                        + ",".join(str(x[0]) for x in b[j:to_b]))
            links.append((a[to_a - 1][0], b[to_b - 1][0]))
            i, j = to_a, to_b
        counts.update(links)
        digest = hashlib.sha256(";".join(told).encode()).hexdigest() if told else ""
        found.append((doc, len(a), len(b), len(told), links, digest))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return sorted(((d, a, b, g, len(links), sum(counts[x] == top[x[1]] for x in links),
                    sum(counts[x] for x in links), h) for d, a, b, g, links, h in found), key=repr)


HARD = ["a\n  b  c \t d▁e", "a\n  b  c \t d  ", "  x\n \n  y  z\x1c q  ", " ", "\n",
        "<s> </s> <unk> <|endoftext|>x", "é́ 你好 \U0001f600\U0001f600 ­", "a\0b"]


def test_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    docs = docs.unionByName(odd.odd_documents(spark).select("doc_id", "text"))
    docs = docs.unionByName(spark.createDataFrame(
        [(-i, t) for i, t in enumerate(HARD, 1)], docs.schema)).cache()
    want = brute([tuple(r) for r in docs.collect()])
    assert odd.rows(alignment.align(docs), *COLUMNS) == want
    # small slices and blocks cut texts at many places
    small = alignment.align(odd.with_extra(docs), slice_chars=200, block_chars=2_000)
    assert odd.rows(small, *COLUMNS) == want
    assert any(r[1] == 0 for r in want) and sum(r[3] for r in want) > 1000


def test_texts_that_end_with_one_space(spark):
    texts = ["x ", " x ", "\n x ", "the mill  by the river ", "你 好 ", "a\xa0b ", "x", "x  ", "x\n ",
             "x▁ ", " ", "  "]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    want = brute([*enumerate(texts)])
    assert [r[0] for r in want if r[1] == 0] == [texts.index("x▁ ")]
    assert odd.rows(alignment.align(docs), *COLUMNS) == want
    # a slice may end right before the space
    assert odd.rows(alignment.align(docs, slice_chars=2), *COLUMNS) == want
    spelled = {r.doc_id: r.end for r in alignment.groups(docs).groupBy("doc_id").agg(
        F.max("end").alias("end")).collect()}
    assert spelled == {i: len(f" {t}".encode()) for i, t in enumerate(texts) if "▁" not in t}


@pytest.mark.parametrize("seed", range(5))
def test_words_have_the_tokens_of_the_whole_text(seed):
    r = random.Random(seed)
    pair = alignment.pair_of(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    for _ in range(60):
        text = "".join(r.choice([" ", " ", "  ", "\n", "\t", "\x1c", "\u2003", "'s", "-", "12", "é",
                                 "the", "River", "你好"]) for _ in range(r.randrange(1, 40)))
        found = ([], [])
        for words in alignment.segments(text, r.randrange(1, 30)):
            numbers = pair.numbers(words)
            assert pair.good.filled()[numbers].all()
            for side in (0, 1):
                found[side].extend(pair.tokens(side, numbers)[0].tolist())
        assert found[0] == pair.a.exact.encode(" " + text, add_special_tokens=False).ids
        assert found[1] == pair.b.encode(text)


def test_groups_are_the_digest(spark):
    docs = odd.odd_documents(spark).filter("doc_id in (1, 9, 10, 13)").dropDuplicates(["doc_id"])
    told = {r.doc_id: r.groups_sha256 for r in alignment.align(docs).collect()}
    groups = alignment.groups(docs).orderBy("doc_id", "start").collect()
    for doc, digest in told.items():
        own = [r for r in groups if r.doc_id == doc]
        assert own[0].start == 0
        assert all(x.end == y.start for x, y in zip(own, own[1:]))
        text = ";".join(f"{','.join(map(str, r.a))}|{','.join(map(str, r.b))}" for r in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digest


@pytest.mark.parametrize("seed", range(20))
def test_coalesce_and_overlaps(seed):
    # intervals with gaps and of any overlap across the sides, against every pair
    r = random.Random(seed)

    def side():
        at, out = 0, []
        for _ in range(r.randrange(1, 12)):
            at += r.randrange(0, 3)
            out.append((at, at := at + r.randrange(1, 5)))
        return np.array(out).T

    a, b = side(), side()
    met = {(i, j) for i in range(len(a[0])) for j in range(len(b[0]))
           if a[0][i] < b[1][j] and b[0][j] < a[1][i]}
    assert set(zip(*(x.tolist() for x in alignment.overlaps(*a, *b)))) == met
    group_a, group_b = alignment.coalesce(*a, *b)
    covered = sorted([*zip(*a.tolist()), *zip(*b.tolist())])
    merged, reach = [], -1
    for start, end in covered:
        if start >= reach:
            merged.append(start)
        reach = max(reach, end)
    for starts, group in ((a[0], group_a), (b[0], group_b)):
        assert group.tolist() == [sum(m <= s for m in merged) - 1 for s in starts]


def test_long_texts_are_cut_between_words():
    text = " ".join("word" * (i % 5) for i in range(5_000)) + "x" * 9_000 + " " * 3_000
    parts = list(alignment.segments(text, 1_000))
    assert "".join(w for part in parts for w in part) == " " + text
    assert len(parts) > 20
    joined = [w for part in parts for w in part]
    assert all(y[0] == " " and not x[-1].isspace() for x, y in zip(joined, joined[1:]))


def test_store_begins_anew(monkeypatch):
    pair = alignment.Pair(public_tokenizers.path(alignment.TOKENIZER_A),
                          public_tokenizers.path(alignment.TOKENIZER_B))
    monkeypatch.setattr(alignment, "KEPT_CHARS", 50)
    for i in range(30):
        words = [f" word{i}", " the", f" x{i}\n"]
        at = pair.numbers(words)
        for side, encode in ((0, lambda w: pair.a.exact.encode(w, add_special_tokens=False).ids),
                             (1, lambda w: pair.b.encode(w[1:]))):
            ids, count = pair.tokens(side, at)
            assert ids.tolist() == [i for w in words for i in encode(w)]
            assert count.tolist() == [len(encode(w)) for w in words]
