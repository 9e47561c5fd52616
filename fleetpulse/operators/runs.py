"""Runs of equal status per key: the shared core of transition dedupe and fault sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Upper bound on the rows of one key handled together when chunking by a dense sequence number.
CHUNK_ROWS = 1_000_000


def sequence_chunk(seq: str, rows: int = CHUNK_ROWS) -> Column:
    return F.floor(F.col(seq) / F.lit(rows))


def order_chunk(df: DataFrame, order: list[str]) -> Column | None:
    """A chunk that never decreases along ``order``: it is cut from the first of its columns.

    Whole numbers are cut into ``CHUNK_ROWS``, times into hours; other kinds are not cut.
    """
    kind = df.schema[order[0]].dataType.typeName()
    if kind in ("long", "integer", "short", "byte"):
        return sequence_chunk(order[0])
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.date_trunc("hour", order[0])
    return None


def status_runs(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    status: str,
    carry: list[str],
    chunk: Column | None = None,
) -> DataFrame:
    """The first row of every run of equal ``status`` per key, with the next run's ``carry``.

    ``order`` is a total order within a key. The result keeps the input columns and adds ``nxt``,
    a struct of the ``carry`` columns of the first row of the following run (null for the last).

    ``chunk`` must never decrease along ``order`` (see :func:`order_chunk`). It splits a hot key: rows are
    first reduced inside (key, chunk), then only the first and last run of each chunk are put in
    sequence per key. Rows strictly inside a chunk stay spread by chunk in the second step too.
    """
    along = [F.col(c) for c in order]
    payload = F.struct(*carry)
    if chunk is None:
        w = Window.partitionBy(*keys).orderBy(*along)
        starts = df.withColumn("_prev", F.lag(status).over(w)).filter(
            F.col("_prev").isNull() | (F.col("_prev") != F.col(status)))
        return starts.withColumn("nxt", F.lead(payload).over(w)).drop("_prev")

    inner = Window.partitionBy(*keys, "_chunk").orderBy(*along)
    local = (
        df.withColumn("_chunk", chunk)
        .withColumn("_prev", F.lag(status).over(inner))
        .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(status)))
        .withColumn("_next", F.lead(payload).over(inner))
    )
    head = F.col("_prev").isNull()
    edge = head | F.col("_next").isNull()
    outer = Window.partitionBy(*keys, "_slot").orderBy(*along)
    placed = (
        local.withColumn("_head", head)
        .withColumn("_slot", F.when(edge, F.lit(None)).otherwise(F.col("_chunk")))
        .withColumn("_before", F.lag(status).over(outer))
        .withColumn("_real", ~F.col("_head") | F.col("_before").isNull()
                    | (F.col("_before") != F.col(status)))
        # a chunk head that continues the run before it hands on the run that follows it
        .withColumn("_offer", F.when(F.col("_real"), payload).otherwise(F.col("_next")))
        .filter(F.col("_offer").isNotNull())
        .withColumn("nxt", F.coalesce("_next", F.lead("_offer").over(outer)))
        .filter("_real")
    )
    return placed.drop("_chunk", "_prev", "_next", "_head", "_slot", "_before", "_real", "_offer")
