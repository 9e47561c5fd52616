"""Toxicity (operator 2): a recurrent network scores overlapping windows that cover every whole text.

Labels are of documents, toxic words are few: a document's score is that of its worst window. The
network learns the same way, from the worst window of each labelled document under the weights so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm import gru
from fleetpulse.llm.arrowtext import steps, text_bytes
from fleetpulse.llm.common import drawn

#: Labelled documents of each label that the network learns from, at most, and the longest one that
#: it learns from. Which ones is decided by a hash of doc_id. Scoring has no such bounds.
SAMPLE, SAMPLE_CHARS = 1000, 20_000
#: The remainder of crc32(doc_id) mod FOLDS that is held out.
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
WARM_ROUNDS, ROUNDS, BATCH = 2, 8, 64


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT


def sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE,
           most_chars: int = SAMPLE_CHARS) -> list[tuple[str, int]]:
    """(text, toxic) of the labelled documents to learn from, at most ``most`` of each label."""
    marked = (labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").filter(~held_out())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    draw = F.xxhash64("doc_id", F.lit(5))
    known = docs.select("doc_id", "text").filter(F.length("text") <= most_chars)
    # a few more ids than needed are drawn before the texts are joined: some texts are too long
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    some = [marked.filter((F.col("toxic") == k) & drawn(draw, 2 * most, counts.get(k, 0)))
            .orderBy(draw).limit(2 * most) for k in (0, 1)]
    both = known.join(F.broadcast(some[0].union(some[1])), "doc_id")
    rows = [both.filter(F.col("toxic") == k).orderBy(draw, "text").limit(most)
            .select("text", "toxic").collect() for k in (0, 1)]
    return [(r.text, int(r.toxic)) for part in rows for r in part]


def learn(examples: list[tuple[str, int]], toxic_share: float = 0.5, warm_rounds: int = WARM_ROUNDS, rounds: int = ROUNDS,
          batch: int = BATCH) -> gru.Network | None:
    """A network that tells the two labels apart; None if the examples have only one.

    The examples may hold the labels in other shares than the corpus; ``toxic_share`` is the true
    one, and the network's bias is moved accordingly at the end.
    """
    label = np.array([y for _, y in examples], dtype="float32")
    if len(set(label.tolist())) < 2:
        return None
    words = gru.read_words(*text_bytes(pa.array([t for t, _ in examples], type=pa.large_string())))
    row, first, end = gru.windows(words.bounds)
    network, rng = gru.Network(), np.random.default_rng(3)
    trainer = gru.Trainer(network)
    marked = network.prime(words, label)
    hints = np.maximum.reduceat(np.append(marked, 0), np.stack([first, end], axis=1).ravel())[::2]
    for turn in range(warm_rounds + rounds):
        # the worst window of each document: at first by its words' evidence
        chosen = worst(hints if turn < warm_rounds else network.scores(words, first, end), row)[1]
        for at in np.array_split(rng.permutation(chosen), max(1, len(chosen) // batch)):
            trainer.step(words, first[at], end[at], label[row[at]])
    seen = float(label.mean())
    network.weights["bias"] += np.log(toxic_share / (1 - toxic_share) * (1 - seen) / seen)
    return network


def worst(scores: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have windows, and each one's window with the highest score."""
    order = np.lexsort((-scores, row))
    rows, first = np.unique(row[order], return_index=True)
    return rows, order[first]


def score(docs: DataFrame, network: gru.Network | None, id_column: str = "doc_id",
          text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` for every row of ``docs``, read whole.

    A null or empty text, or one without letters, scores 0; so does every text if there is no
    network. Rows are independent; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in steps(batches):
            found = np.zeros(batch.num_rows)
            if net is not None:
                words = gru.read_words(*text_bytes(batch.column(1)))
                row, first, end = gru.windows(words.bounds)
                logits = net.scores(words, first, end).astype("float64")
                if len(row):
                    rows, at = worst(logits, row)
                    found[rows] = 1 / (1 + np.exp(-logits[at]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(found),
                 pa.array((found >= threshold).astype("int32"))],
                names=["doc_id", "score", "predicted"])

    return docs.select(F.col(f"`{id_column}`").alias("doc_id"),
                       F.col(f"`{text_column}`").alias("text")).mapInArrow(
        run, "doc_id long, score double, predicted int")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled rows that are not held out, score all: doc_id, held_out, score, predicted.

    A null doc_id is not held out. Null and empty texts score as texts without words; a very long text
    is scored window by window in bounded memory. Repeated rows get equal scores. Without labelled rows
    to learn from, all scores are equal. Other columns are not read; an empty table gives no rows.
    """
    share = labels.filter("toxic IN (0, 1)").filter(~held_out()).agg(
        F.avg("toxic")).first()[0] or 0.5
    scored = score(docs, learn(sample(docs, labels), share))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         "predicted")
