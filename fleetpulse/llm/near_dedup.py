"""MinHash near-dedup (operator 5) with BagMinHash signatures.

A text is a bag of five-word shingles. Each shingle spreads points over the signature's components
by Poisson processes, one hierarchy for each element: level ``b`` holds the discretised weights
``2^b .. 2^(b+1) - 1`` and only the points below the element's own weight count. A component keeps its
earliest point, so two bags agree in a component with the probability of their weighted Jaccard
similarity. Bands of components propose pairs; pairs are settled by counting common shingles.

From candidates to classes without all pairs of a bucket:

1. equal bags are one node;
2. of the nodes that share a band with another node, a shingle that no other such node has can't be
   matched; a node with too many of them can't reach the threshold with any partner and is left out;
3. in each band bucket all nodes are compared with the one whose shingles are most widely shared;
4. nodes of a bucket that are still in different components meet in tiles of two bounded parts of the
   nodes of their bucket's lead. What the parts share is counted by matrix products, and only links
   that connect components leave the task. Pairs within a component can't change it.

So every proposed pair is settled: by comparison, by a bound, or by lying within one component. Rows grow
with the nodes, not with their pairs; the work within tiles grows with the pairs only where many texts
of one family are below the threshold to each other and to their leads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.arrowtext import (
    mix,
    occurrences,
    shingle_hashes,
    span_hashes,
    steps,
    text_bytes,
    word_spans,
)
from fleetpulse.llm.common import checkpoint
from fleetpulse.llm.links import components

WIDTH = 5
#: Least similarity, as a fraction of whole numbers so that no rounding decides.
THRESHOLD = (4, 5)
BANDS = 24
BAND_ROWS = 4
#: Nodes and tokens of a part of a tile, and columns of a matrix that one product takes.
TILE_ROWS, TILE_TOKENS, COLUMNS = 1024, 2_000_000, 4096
#: Ids of nodes to compare are sent to all tasks up to this number; more are joined by shuffle.
BROADCAST_NODES = 500_000

SIGNED = ("doc_id long, bag1 long, bag2 long, weight long, bands array<long>")


def _shingles(batch: pa.RecordBatch, width: int):
    data, offsets = text_bytes(batch.column(1))
    starts, ends, bounds = word_spans(data, offsets)
    h, rows = shingle_hashes(span_hashes(data, starts, ends), bounds, width)
    return occurrences(h, rows)


def bag_minhash(h: np.ndarray, rows: np.ndarray, weights: np.ndarray, n_rows: int,
                size: int) -> np.ndarray:
    """Signatures (n_rows x size) of bags given as distinct elements with whole weights.

    Points are made in order of time, element by element, up to a time by which each row can expect
    all its components to be hit; rows with an unhit component go on to twice that time. Every
    point up to the final time is seen, so each component has its true earliest point. Rows
    without elements keep infinity.
    """
    total = np.bincount(rows, weights=weights, minlength=n_rows)
    until = (np.log(size) + 2.5) / np.maximum(total, 1)
    signature = np.full(n_rows * size, np.inf)
    # one process for each element and level of its weight
    elements, levels, rates, caps = [], [], [], []
    level = 0
    while len(at := np.flatnonzero(weights >= 1 << level)):
        elements.append(at)
        levels.append(np.full(len(at), level, dtype="uint64"))
        rates.append(np.full(len(at), float(size << level)))
        caps.append(np.minimum(weights[at] - (1 << level) + 1, 1 << level))
        level += 1
    if not elements:
        return signature.reshape(n_rows, size)
    at = np.concatenate(elements)
    level_of, rate, cap = map(np.concatenate, (levels, rates, caps))
    state = mix(h[at] + (level_of + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
    row, time = rows[at], np.zeros(len(at))

    def advance(state, time, rate):
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        uniform = ((state >> np.uint64(11)).astype("float64") + 0.5) * 2.0 ** -53
        return state, time - np.log(uniform) / rate

    state, time = advance(state, time, rate)
    while len(state):
        # processes drop out as they pass their row's time, and wait there
        at = np.flatnonzero(time <= until[row])
        s, t, r, lv, rt, cp = (x[at] for x in (state, time, row, level_of, rate, cap))
        while len(at):
            place = mix(s ^ np.uint64(0xA0761D6478BD642F))
            counts = ((place >> np.uint64(40)) & ((np.uint64(1) << lv) - np.uint64(1))
                      ).astype("int64") < cp
            component = ((place & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)
                         ).astype("int64")
            np.minimum.at(signature, (r * size + component)[counts], t[counts])
            s, t = advance(s, t, rt)
            go = t <= until[r]
            if not go.all():
                out = at[~go]
                state[out], time[out] = s[~go], t[~go]
                at, s, t, r, lv, rt, cp = (x[go] for x in (at, s, t, r, lv, rt, cp))
        unhit = np.isinf(signature.reshape(n_rows, size)).any(axis=1) & (total > 0)
        if not unhit.any():
            break
        until[unhit] *= 2
        again = unhit[row]
        state, time, row, level_of, rate, cap = (
            x[again] for x in (state, time, row, level_of, rate, cap))
    return signature.reshape(n_rows, size)


def signed(docs: DataFrame, width: int = WIDTH, bands: int = BANDS,
           band_rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, two hashes of the bag, its weight, and one hash for each band (none if empty)."""
    size = bands * band_rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            n = batch.num_rows
            h, rows, nth = _shingles(batch, width)
            weight = np.bincount(rows, minlength=n)
            single = nth == 0
            starts = np.flatnonzero(single)
            counts = np.diff(np.r_[starts, len(h)])
            tokens = mix(h + nth.astype("uint64") * np.uint64(0xC2B2AE3D27D4EB4F))
            bags = []
            for salt in (0x165667B19E3779F9, 0x27D4EB2F165667C5):
                sums = np.append(np.uint64(0), np.cumsum(mix(tokens ^ np.uint64(salt))))
                ends = np.cumsum(weight)
                bags.append(pa.array((sums[ends] - sums[ends - weight]).view("int64")))
            signature = bag_minhash(h[starts], rows[starts], counts, n, size)
            words = signature.view("uint64").reshape(n, bands, band_rows)
            keys = np.zeros((n, bands), dtype="uint64")
            keys += np.arange(1, bands + 1, dtype="uint64") * np.uint64(0x9FB21C651E98DF25)
            for k in range(band_rows):
                keys = mix(keys ^ words[:, :, k])
            filled = weight > 0
            offsets = np.r_[0, np.cumsum(np.where(filled, bands, 0))].astype("int32")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *bags, pa.array(weight.astype("int64")),
                 pa.ListArray.from_arrays(pa.array(offsets),
                                          pa.array(keys[filled].ravel().view("int64")))],
                names=["doc_id", "bag1", "bag2", "weight", "bands"])

    return docs.mapInArrow(sign, SIGNED)


def _tokens(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and the array of its (shingle, number among equals) hashes."""

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            h, rows, nth = _shingles(batch, width)
            both = mix(h + nth.astype("uint64") * np.uint64(0xC2B2AE3D27D4EB4F)).view("int64")
            counts = np.bincount(rows, minlength=batch.num_rows)
            offsets = np.r_[0, np.cumsum(counts)].astype("int32")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(both))],
                names=["node", "tokens"])

    return docs.mapInArrow(tokens, "node long, tokens array<long>")


def _may_reach(overlap: Column, one: Column, other: Column, threshold: tuple[int, int]) -> Column:
    """Whether ``overlap / (one + other - overlap)`` reaches the threshold."""
    over, under = threshold
    return overlap * (over + under) >= F.lit(over) * (one + other)


def _settle(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) whose bags reach the threshold."""
    of_a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("of_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    return (pairs.join(of_a, "a").join(of_b, "b")
            .filter(_may_reach(common, F.size("of_a"), F.size("of_b"), threshold))
            .select("a", "b"))


def overlaps(left: np.ndarray, of_left: np.ndarray, right: np.ndarray, of_right: np.ndarray,
             rows: tuple[int, int]) -> np.ndarray:
    """How many tokens each row of the left has in common with each of the right.

    ``left`` and ``right`` are the tokens, ``of_…`` the row of each. Tokens of both sides are counted by
    products of incidence matrices, some columns at a time. If the sides are the same rows, what a row
    has in common with itself is not counted whole.
    """
    if left is right:
        common, often = np.unique(left, return_counts=True)
        common = common[often > 1]  # the others tell no two rows alike
    else:
        common = np.intersect1d(left, right)
    out = np.zeros(rows, dtype="float32")
    for begin in range(0, len(common), COLUMNS):
        some = common[begin:begin + COLUMNS]
        sides = []
        for tokens, of, n in ((left, of_left, rows[0]), (right, of_right, rows[1])):
            at = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
            hit = some[at] == tokens
            matrix = np.zeros((n, len(some)), dtype="float32")
            matrix[of[hit], at[hit]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def _forest(a: np.ndarray, b: np.ndarray, component: np.ndarray) -> list[int]:
    """Numbers of the pairs that connect components not yet connected by the pairs before."""
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    kept = []
    for n, (x, y) in enumerate(zip(component[a].tolist(), component[b].tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            kept.append(n)
    return kept


def _settle_tile(table: pa.Table, threshold: tuple[int, int]) -> pa.Table:
    """Links between rows of a tile in different components, as many as connect them.

    A tile holds one part of a lead's nodes, or two, of which only rows of different parts are
    compared.
    """
    over, under = threshold
    node, component, part = (table[c].to_numpy() for c in ("node", "component", "part"))
    lists = table["tokens"].combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    tokens, w = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    of = np.repeat(np.arange(len(node)), w)
    ones = part == part.min()
    others = ~ones if not ones.all() else ones
    rows = np.flatnonzero(ones), np.flatnonzero(others)
    place = np.empty(len(node), dtype="int64")
    sides = []
    for some, mask in zip(rows, (ones, others)):
        place[some] = np.arange(len(some))
        sides += [tokens[mask[of]], place[of[mask[of]]]]
    if others is ones:
        sides[2:] = sides[:2]
    common = overlaps(*sides, (len(rows[0]), len(rows[1])))
    needed = over * (w[rows[0]][:, None] + w[rows[1]][None, :])
    linked = ((over + under) * common >= needed) & (
        component[rows[0]][:, None] != component[rows[1]][None, :])
    i, j = np.nonzero(linked)
    i, j = rows[0][i], rows[1][j]
    kept = _forest(i, j, component)
    a, b = node[i[kept]], node[j[kept]]
    return pa.table({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})


def _across(apart: DataFrame, sets: DataFrame, threshold: tuple[int, int],
            tile_rows: int) -> DataFrame:
    """Links between nodes of a lead's buckets that are in different components.

    ``apart`` has lead, node, component and w. The nodes of a lead are dealt to parts of some
    ``tile_rows`` nodes and ``TILE_TOKENS`` tokens; each two parts meet in a tile, and what they share
    is counted there in bounded memory. Only links that connect components leave a tile, never its
    pairs. Small leads share a task.
    """
    # how much of a part one node takes
    room = F.greatest(F.lit(1.0 / tile_rows), F.col("w") / TILE_TOKENS)
    sizes = apart.groupBy("lead").agg(F.sum(room).alias("room"), F.min("component").alias("low"),
                                      F.max("component").alias("high")).filter("low <> high")
    sizes = checkpoint(sizes.select("lead", F.ceil("room").alias("parts"), "room"))
    bins = max(1, math.ceil(sizes.agg(F.sum("room")).first()[0] or 0))
    dealt = apart.join(sizes, "lead").withColumn(
        "part", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(0))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "lead", "node", "component", "part", F.least("part", "other").alias("one"),
        F.greatest("part", "other").alias("two"),
        F.when(F.col("parts") > 1, F.xxhash64("lead", F.least("part", "other"),
                                              F.greatest("part", "other")))
        .otherwise(F.pmod(F.xxhash64("lead"), F.lit(bins))).alias("tile"))

    def settle(table: pa.Table) -> pa.Table:
        keys = np.stack([table[c].to_numpy() for c in ("lead", "one", "two")], axis=1)
        order = np.lexsort(keys.T[::-1])
        edges = np.flatnonzero(np.r_[True, (np.diff(keys[order], axis=0) != 0).any(axis=1)])
        return pa.concat_tables([_settle_tile(table.take(some), threshold)
                                 for some in np.split(order, edges[1:])])

    nodes = dealt.select("node").distinct()
    if nodes.count() <= BROADCAST_NODES:
        nodes = F.broadcast(nodes)
    wanted = sets.join(nodes, "node", "left_semi")
    return (tiles.join(wanted, "node").groupBy("tile").applyInArrow(settle, "a long, b long")
            .distinct())


def classes(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD,
            bands: int = BANDS, band_rows: int = BAND_ROWS,
            tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, weight, n_links.

    ``class_id`` is the least doc_id of the texts that are linked with this one, over any number of
    steps; ``n_links`` counts the links that connect the class (0 for a text alone or with equal copies
    only; not every link of a class is looked for), ``weight`` the shingles. Texts are linked if their bags of shingles have a weighted
    Jaccard similarity of at least ``threshold``. A text of fewer than ``width`` words is one
    shingle; a null text or one without words is linked to nothing and is its own class. A row
    without doc_id gets class null. Rows that share a doc_id are one document. Other columns of
    ``docs`` are not read.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = checkpoint(signed(read, width, bands, band_rows))
    known = rows.filter("doc_id IS NOT NULL AND weight > 0")
    nodes = known.groupBy("bag1", "bag2").agg(F.min("doc_id").alias("node"))
    firsts = nodes.select(F.col("node").alias("doc_id")).distinct()
    buckets = (known.join(firsts, "doc_id", "left_semi")
               .select(F.col("doc_id").alias("node"), F.explode("bands").alias("bucket"))
               .distinct())
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = checkpoint(buckets.join(shared.select("bucket"), "bucket", "left_semi"))

    compared = checkpoint(members.select("node").distinct())
    small = compared.count() <= BROADCAST_NODES
    ids = compared.withColumnRenamed("node", "doc_id")
    sets = checkpoint(_tokens(read.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi"),
                              width).dropDuplicates(["node"]))
    lone = (sets.select("node", F.explode("tokens").alias("token")).groupBy("token")
            .agg(F.count("*").alias("n"), F.min("node").alias("node"))
            .filter("n = 1").groupBy("node").agg(F.count("*").alias("lone")))
    bags = sets.select("node", F.size("tokens").cast("long").alias("w")).join(
        lone, "node", "left").select("node", "w", (
            F.col("w") - F.coalesce("lone", F.lit(0))).alias("most"))
    # a partner of w' shingles shares at most min(most, w') with a node: best is w' near most
    hopeful = bags.filter(_may_reach(F.col("most"), F.col("w"), F.col("most"), threshold))
    places = checkpoint(members.join(hopeful, "node"))

    rank = F.struct((F.col("most") / F.col("w")).alias("share"), (-F.col("node")).alias("last"))
    lead = places.groupBy("bucket").agg(F.max(rank).alias("best"), F.count("*").alias("n")).filter(
        "n > 1").select("bucket", (-F.col("best.last")).alias("lead"))
    led = lead.join(bags.select(F.col("node").alias("lead"), F.col("w").alias("lead_w"),
                                F.col("most").alias("lead_most")), "lead")
    stars = (places.join(led, "bucket").filter(F.col("node") != F.col("lead"))
             .filter(_may_reach(F.least("most", "lead_most"), F.col("w"), F.col("lead_w"),
                                threshold))
             .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
             .distinct())
    first_links = checkpoint(_settle(stars, sets, threshold))

    part = components(first_links)
    sorted_out = checkpoint(places.join(part, "node", "left").withColumn(
        "component", F.coalesce("component", "node")))
    mixed = (sorted_out.groupBy("bucket").agg(F.min("component").alias("low"),
                                              F.max("component").alias("high"))
             .filter("low <> high").select("bucket"))
    # the lead has been compared with all of them
    apart = checkpoint(sorted_out.join(mixed, "bucket", "left_semi").join(lead, "bucket")
                       .filter("node <> lead").select("lead", "node", "component", "w").distinct())
    links = checkpoint(first_links.union(
        _across(apart, sets, threshold, tile_rows)).distinct())
    whole = components(links)
    degree = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
              .agg(F.count("*").alias("n_links")))
    found = (nodes.join(whole, "node", "left").join(degree, "node", "left")
             .select("bag1", "bag2", F.coalesce("component", "node").alias("found"), "n_links"))
    out = rows.join(found, ["bag1", "bag2"], "left")
    alone = (F.col("weight") == 0) | F.col("found").isNull()
    return out.select(
        "doc_id",
        F.when(F.col("doc_id").isNull(), F.lit(None)).when(alone, F.col("doc_id"))
        .otherwise(F.col("found")).alias("class_id"),
        "weight", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stand for their class, one for each; columns as they are.

    Rows without doc_id can't be told apart and all stay.
    """
    found = classes(docs, **options)
    lasting = found.filter("doc_id = class_id").select(
        F.col("doc_id").alias("__kept")).distinct()
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = (docs.join(lasting, F.col("doc_id").cast("long") == F.col("__kept"), "left_semi")
            .dropDuplicates(["doc_id"]))
    return kept.select(*names).unionByName(docs.filter("doc_id IS NULL").select(*names))


def oracle(width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD) -> str:
    """The query op5_near_dedup in DuckDB's SQL: all pairs that share a shingle, then all reachable."""
    over, under = threshold
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''),
    '[ \\t-\\r]+'), lambda x: x <> '') AS words FROM documents),
one AS (SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < {width} THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - {width - 2}),
      lambda i: array_to_string(words[i:i + {width - 1}], ' ')) END) AS shingle FROM w),
bag AS (SELECT doc_id, shingle, count(*) AS n FROM one GROUP BY ALL),
size AS (SELECT doc_id, sum(n)::BIGINT AS weight FROM bag GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, sum(least(a.n, b.n)) AS common
  FROM bag a JOIN bag b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y
  WHERE {over + under} * common >= {over} * (s.weight + t.weight)),
both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents
  UNION SELECT b.y, r.other FROM reach r JOIN both_ways b ON r.doc_id = b.x)
SELECT r.doc_id, min(other) AS class_id, coalesce(any_value(weight), 0) AS weight,
  r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN size USING (doc_id) GROUP BY r.doc_id"""
