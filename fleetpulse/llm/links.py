"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import checkpoint


#: Links that one task takes: tables of links are kept in as many partitions as their rows call for,
#: whatever the session's number is, as rounds are many and tables shrink.
TASK_LINKS = 200_000


def _star(pairs: DataFrame, large: bool, parts: int) -> DataFrame:
    """Hang the larger (or the smaller and own) neighbours of every node on its least one."""
    both = pairs.union(pairs.select("b", "a"))
    seen = both if large else both.filter("b < a")
    least = seen.groupBy("a").agg(F.min("b").alias("least")).coalesce(parts)
    if large:
        least = least.select("a", F.least("a", "least").alias("least"))
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"),
                                                            F.col("least").alias("b"))
    else:
        moved = seen.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.union(least.select("a", "least"))
    return moved.filter("a <> b").coalesce(parts).distinct().coalesce(parts)


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component``: the least node of its component, for every node with a link.

    ``links`` has two long columns. No neighbour list is ever gathered: a node's least neighbour is
    an aggregate and goes back to its links by a join, so a node with very many links is dealt out.
    Rounds grow with the logarithm of the longest path.
    """
    a, b = links.columns
    parts = max(1, -(-links.count() // TASK_LINKS))
    pairs = checkpoint(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                       .filter("a <> b").coalesce(parts).distinct().coalesce(parts))
    seen = None
    while True:
        pairs = checkpoint(_star(_star(pairs, True, parts), False, parts))
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    roots = pairs.select(F.col("b").alias("node")).distinct()
    return (pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(roots.select("node", F.col("node").alias("component"))))
