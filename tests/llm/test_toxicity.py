"""Toxicity: gradients against differences, windows, and accuracy on held-out documents."""

import zlib

import numpy as np
import pyarrow as pa

from fleetpulse.llm import gru, toxicity
from fleetpulse.llm.arrowtext import text_bytes


def read(texts):
    return gru.read_words(*text_bytes(pa.array(texts, type=pa.large_string())))


def test_windows_cover_every_word():
    words = read(["", "one", " ".join(["w"] * 32), " ".join(["w"] * 33), " ".join(["w"] * 100)])
    row, first, end = gru.windows(words.bounds)
    assert np.bincount(row, minlength=5).tolist() == [0, 1, 1, 2, 6]
    for r in range(5):
        seen = {k for a, b in zip(first[row == r], end[row == r]) for k in range(a, b)}
        assert seen == set(range(words.bounds[r], words.bounds[r + 1]))
    # neighbours overlap
    assert (first[row == 4][1:] < end[row == 4][:-1]).all()


def test_step_follows_the_slope():
    """What a step moves is the slope of the loss, compared with differences of the loss."""
    words = read(["some short words go here and there", "bad words come often, very often"] * 2)
    _, first, end = gru.windows(words.bounds)
    label = np.array([0, 1, 0, 1], dtype="float32")

    def loss(net):
        p = 1 / (1 + np.exp(-net.scores(words, first, end).astype("float64")))
        return -np.mean(np.where(label > 0, np.log(p), np.log(1 - p)))

    class Watched(gru.Trainer):
        def _move(self, name, at, slope):
            self.seen = getattr(self, "seen", {})
            self.seen.setdefault(name, (at, np.array(slope)))

    rng = np.random.default_rng(4)
    net = gru.Network()
    net.weights["word"] = rng.normal(0, 0.5, net.weights["word"].shape).astype("float32")
    trainer = Watched(net)
    trainer.step(words, first, end, label)
    for name, (at, slope) in trainer.seen.items():
        table = net.weights[name]
        view = np.arange(table.shape[0])[at]
        for _ in range(3):
            i = rng.integers(len(view))
            place = (view[i], *(rng.integers(k) for k in table.shape[1:]))
            got = slope.reshape((len(view), *table.shape[1:]))[(i, *place[1:])]
            kept, d = table[place], 0.02
            table[place] = kept + d
            up = loss(net)
            table[place] = kept - d
            down = loss(net)
            table[place] = kept
            assert abs((up - down) / (2 * d) - got) < 2e-3, name


def test_training_and_scoring_agree():
    texts = [f"word{chr(97 + i % 26)} and some idiot went by" if i % 2 else
             f"word{chr(97 + i % 26)} and some friend went by" for i in range(60)]
    net = toxicity.learn([(t, i % 2) for i, t in enumerate(texts)])
    words = read(["an idiot came", "a friend came", ""])
    row, first, end = gru.windows(words.bounds)
    scores = net.scores(words, first, end)
    assert scores[0] > scores[1] and len(scores) == 2


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = toxicity.judge(docs.join(labels.select("doc_id"), "doc_id"), labels).join(
        labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    toxic = held.toxic == 1
    predicted = held.predicted == 1
    # some 330 toxic examples here, of three languages only 22 to 51
    assert (predicted & toxic).sum() >= 0.8 * toxic.sum()
    assert (predicted & ~toxic).sum() <= 0.03 * (~toxic).sum()
    assert ((got.score >= 0) & (got.score <= 1)).all()


def test_one_label_only(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.judge(docs, labels).collect()] == [0.0, 0.0]
