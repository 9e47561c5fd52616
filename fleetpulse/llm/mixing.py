"""Mixing sources to target weights (operator 3) by Sainte-Lague apportionment.

Sizes are words. Sources get targets; targets are allotted in blocks of equal size to sources by
highest quotients ``target / (2 k + 1)``, each source's blocks the same way to its shards, and each
shard picks its quota of blocks of its documents in a seeded order. Every group that one task sees
is bounded: a shard holds a bounded number of documents, and apportionment goes down a tree with at
most ``fan_out`` children a node, however many shards a source has.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import checkpoint, n_words_of, ranked, text_of

# The contract's weights by the rank of a source, repeating, and its ceiling.
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3

BLOCK_WORDS = 32
SHARD_WORDS = 32_768
SHARD_DOCS = 96
FAN_OUT = 512
SEED = 20240607
#: Prime steps for walking through a shard's blocks; all above any number of blocks in a shard.
STEPS = (1_000_003, 1_000_033, 1_000_037, 1_000_039, 1_000_081, 1_000_099, 1_000_117)
#: A source table of up to this many rows is sent to all tasks; a larger one is joined by shuffle.
BROADCAST_SOURCES = 20_000


def sainte_lague(votes: np.ndarray, seats: int) -> np.ndarray:
    """Seats by highest quotients ``votes / (2 k + 1)``; ties go to the earlier place.

    Starts from the rounded shares, then gives to the highest next quotient or takes from the
    lowest last one until the number is right.
    """
    votes = np.asarray(votes, dtype="float64")
    total = votes.sum()
    if seats <= 0 or total <= 0:
        return np.zeros(len(votes), dtype="int64")
    got = np.floor(votes * (seats / total) + 0.5).astype("int64")
    while (missing := seats - int(got.sum())) != 0:
        if missing > 0:
            got[np.argmax(votes / (2 * got + 1))] += 1
        else:
            last = np.where(got > 0, votes / np.maximum(2 * got - 1, 1), np.inf)
            got[len(got) - 1 - np.argmin(last[::-1])] -= 1
    return got


def _seats_of_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("node", ignore_index=True)
    pdf["seats"] = sainte_lague(pdf["votes"].to_numpy(), int(pdf["parent_seats"].iloc[0]))
    return pdf[["branch", "node", "votes", "seats"]]


def apportion(leaves: DataFrame, seats: DataFrame, fan_out: int = FAN_OUT) -> DataFrame:
    """Seats of every leaf.

    ``leaves``: branch long, node long (0.. within its branch), votes double. ``seats``: branch
    long, seats long. Nodes are gathered ``fan_out`` at a time, level by level; each parent's seats
    go to its children by highest quotients. Returns branch, node, votes, seats.
    """
    top = leaves.agg(F.max("node")).first()[0]
    if top is None:
        return leaves.withColumn("seats", F.lit(0).cast("long"))
    levels, width = 1, fan_out
    while top >= width:
        levels, width = levels + 1, width * fan_out
    above = seats.select("branch", F.col("seats").alias("parent_seats"))
    given = None
    for level in reversed(range(levels)):
        size = fan_out ** level
        node = F.floor(F.col("node") / size).cast("long")
        nodes = (leaves.groupBy("branch", node.alias("node")).agg(F.sum("votes").alias("votes"))
                 if level else leaves.select("branch", "node", "votes"))
        nodes = nodes.withColumn("parent", F.floor(F.col("node") / fan_out).cast("long"))
        given = (nodes.join(above, ["branch", "parent"] if "parent" in above.columns else "branch")
                 .groupBy("branch", "parent")
                 .applyInPandas(_seats_of_group, "branch long, node long, votes double, seats long"))
        above = given.select("branch", F.col("node").alias("parent"),
                             F.col("seats").alias("parent_seats"))
    return given


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rank, weight and target of every source.

    ``sizes``: source, source_size, source_docs. The words of all sources are shared by weight; a
    target stops at three times its source's size and the excess is shared again by weight. The
    water level is found by sums over the source table, a few numbers a round.
    """
    order = [F.col("source").isNull().cast("int"), F.col("source")]
    table = ranked(sizes, order, "branch")
    weight = F.element_at(F.array(*(F.lit(w) for w in WEIGHTS)),
                          (F.col("branch") % len(WEIGHTS) + 1).cast("int"))
    table = checkpoint(table.withColumn("weight", weight.cast("double")).withColumn(
        "most", (MOST_REPEATS * F.col("source_size")).cast("double")))
    total, weights = table.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total / weights) if total else 0.0
    while total:
        full = F.col("most") <= F.lit(level) * F.col("weight")
        held, free = table.agg(F.sum(F.when(full, F.col("most")).otherwise(0.0)),
                               F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not free or (risen := (total - held) / free) <= level:
            break
        level = risen
    return table.withColumn("target", F.least(F.col("most"), F.lit(float(level)) * F.col("weight")))


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", carry: tuple[str, ...] = (), whole_documents: bool = False,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        shard_docs: int = SHARD_DOCS, fan_out: int = FAN_OUT, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: id, source, ``carry``, size, source_size, target, taken.

    ``size`` is the number of words, 0 for a null or empty text; such documents are never taken.
    ``taken`` counts the words that the mix takes, repeats included, at most three times the size.
    Rows are told apart by their place only, so repeated rows each have their own share; ties in
    the seeded order are broken by id and text. An empty table gives an empty result. With
    ``whole_documents`` a shard's quota is filled by whole documents: ``taken`` is a multiple of
    ``size``.
    """
    picked = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source"),
        n_words_of(text_of(f"`{text_column}`")).alias("size"),
        F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.col(f"`{text_column}`")).alias("draw"),
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried") if carry
        else F.lit(None).cast("int").alias("carried"))
    sources = picked.groupBy("source").agg(F.sum("size").alias("source_size"),
                                           F.count("*").alias("source_docs"))
    targets = checkpoint(source_targets(sources).withColumn("shards", F.greatest(
        F.lit(1), F.ceil(F.col("source_size") / shard_words),
        F.ceil(F.col("source_docs") / shard_docs)).cast("long")))
    n_sources, total = targets.agg(F.count("*"), F.sum("source_size")).first()
    facts = targets.select("source", "branch", "shards", "source_size", "target")
    if n_sources <= BROADCAST_SOURCES:
        facts = F.broadcast(facts)
    placed = (picked.join(facts.withColumnRenamed("source", "of_source"),
                          F.col("source").eqNullSafe(F.col("of_source")))
              .drop("of_source")
              .withColumn("shard", F.pmod(F.col("draw"), F.col("shards"))))
    shards = checkpoint(placed.groupBy("branch", F.col("shard").alias("node"))
                        .agg(F.sum("size").cast("double").alias("votes")))
    # all sources are in one branch; a number that planning doesn't see through keeps the join on it
    root = F.pmod(F.col("branch"), F.lit(1))
    blocks = math.floor((total or 0) / block_words + 0.5)
    spark = docs.sparkSession
    of_source = apportion(
        targets.select(root.alias("branch"), F.col("branch").alias("node"),
                       F.col("target").alias("votes")),
        spark.createDataFrame([(0, blocks)], "branch long, seats long"), fan_out)
    of_shard = apportion(shards, of_source.select(F.col("node").alias("branch"), "seats"), fan_out)
    quotas = of_shard.select("branch", F.col("node").alias("shard"), "seats",
                             F.col("votes").cast("long").alias("shard_size"))

    # the seeded stream of a shard: its documents one after another
    shard = Window.partitionBy("branch", "shard").orderBy("draw", "id")
    stream = placed.withColumn(
        "begin", F.sum("size").over(shard.rowsBetween(Window.unboundedPreceding, 0))
        - F.col("size"))
    stream = stream.join(quotas, ["branch", "shard"])
    length = F.col("shard_size")
    wanted = F.least(F.col("seats") * block_words, MOST_REPEATS * length)
    passes = F.floor(wanted / F.greatest(length, F.lit(1))).cast("long")
    stream = stream.withColumn("passes", passes).withColumn("rest", wanted - passes * length)
    if whole_documents:
        part = F.when(F.col("begin") + F.col("size") / 2 <= F.col("rest"),
                      F.col("size")).otherwise(F.lit(0))
    else:
        part = _chosen_words(block_words, seed)
    taken = F.col("passes") * F.col("size") + F.when(F.col("rest") > 0, part).otherwise(F.lit(0))
    carried = [F.col("carried")[c].alias(c) for c in carry]
    return stream.select(F.col("id").alias(id_column), F.col("source").alias(source_column),
                         *(c for c in carried), "size", "source_size", "target",
                         taken.cast("long").alias("taken"))


def _chosen_words(block_words: int, seed: int):
    """Words of a document in its shard's chosen blocks.

    A walk through the shard's blocks puts block ``j`` at place ``(step * j + shift) mod blocks``. The
    prime step is larger than any number of blocks, so every block has a place of its own; step and shift
    are drawn per shard. Blocks are taken in that order until the rest of the quota is filled, the
    last one in part; what the shard's short last block lacks is made good by the next.
    """
    length, begin, size, rest = (F.col(c) for c in ("shard_size", "begin", "size", "rest"))
    blocks = F.ceil(length / block_words).cast("long")
    draw = F.xxhash64(F.lit(seed), F.col("branch"), F.col("shard"))
    step = F.element_at(F.array(*(F.lit(s) for s in STEPS)),
                        (F.pmod(draw, F.lit(len(STEPS))) + 1).cast("int")).cast("long")
    shift = F.pmod(F.shiftright(draw, 8), blocks)
    short = F.when(F.pmod(step * (blocks - 1) + shift, blocks) * block_words < rest,
                   blocks * block_words - length).otherwise(F.lit(0).cast("long"))
    first = F.floor(begin / block_words).cast("long")
    last = F.floor((begin + size - 1) / block_words).cast("long")

    def words(total, j):
        left = rest + short - F.pmod(step * j + shift, blocks) * block_words
        taken = F.greatest(F.least(left, F.lit(block_words).cast("long")), F.lit(0).cast("long"))
        return total + F.greatest(
            F.least(begin + size, j * block_words + taken) - F.greatest(begin, j * block_words),
            F.lit(0).cast("long"))

    return F.when(size > 0, F.aggregate(F.sequence(first, last), F.lit(0).cast("long"), words)
                  ).otherwise(F.lit(0))


def resample(docs: DataFrame) -> DataFrame:
    """``docs`` mixed by whole documents: a row is left out or repeated up to three times.

    Rows keep their own columns, whatever their names; documents without words are left out.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    mixed = mix(docs.select("doc_id", "text", "source", row), carry=("row",), whole_documents=True)
    copies = F.when(F.col("size") > 0, F.col("taken") / F.greatest("size", F.lit(1))).otherwise(0)
    return (mixed.select("row", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
            .select("row.*"))
