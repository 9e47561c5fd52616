"""Change logs of source tables: ``(op, seq, before, after)`` rows as JSON text."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.operators.replication import with_snapshot
from fleetpulse.sources.keyed import Files
from fleetpulse.sources.topics import messages

LOW, HIGH = "low", "high"


def change_schema(table: StructType) -> StructType:
    return (StructType().add("op", "string").add("seq", "long")
            .add("before", table).add("after", table))


def change_rows(raw: DataFrame, table: StructType) -> DataFrame:
    """Decode a topic (stream or batch) of change rows; ``seq`` is the change's own position."""
    return messages(raw.select("value"), change_schema(table)).select(
        "op", "seq", "before", "after")


def snapshot_then_changes(snapshot: DataFrame, raw: DataFrame, table: StructType) -> DataFrame:
    """Whole table first, then its log: for a log that no longer reaches back to the start."""
    return with_snapshot(snapshot, change_rows(raw, table))


def scan_chunks(
    spark: SparkSession, bounds: list[Any], read: Callable[[Any, Any], DataFrame],
    position: Callable[[], int], staging: str,
) -> DataFrame:
    """Scan a table beside its live log, by ranges of its key; rows with ``low`` and ``high``.

    ``bounds`` are the key's range ends in order; ``read(lower, upper)`` gives the rows with
    ``lower <= key < upper`` (None for no bound), ``position()`` the log's newest position. A chunk is
    read between two positions and holds every change up to ``low``; those between ``low`` and ``high``
    it may hold or not, so they must be applied again. Chunks are written under ``staging`` and one
    that is there whole is not read again, so a scan that was stopped goes on.
    """
    files = Files(spark, staging)
    ends = [None, *bounds, None]
    for number, (lower, upper) in enumerate(zip(ends, ends[1:])):
        if files.exists(f"{number}/done"):
            continue
        files.delete(str(number))
        low = position()
        read(lower, upper).write.parquet(f"{staging}/{number}/rows")
        span = spark.createDataFrame([(low, position())], f"{LOW} bigint, {HIGH} bigint")
        span.coalesce(1).write.parquet(f"{staging}/{number}/span")
        files.write(f"{number}/writing", "")
        files.rename(f"{number}/writing", f"{number}/done")
    chunks = []
    for number in range(len(ends) - 1):
        low, high = spark.read.parquet(f"{staging}/{number}/span").first()
        chunks.append(spark.read.parquet(f"{staging}/{number}/rows").withColumns(
            {LOW: F.lit(low).cast("bigint"), HIGH: F.lit(high).cast("bigint")}))
    out = chunks[0]
    for chunk in chunks[1:]:
        out = out.unionByName(chunk)
    return out


def images_of_scan(scan: DataFrame) -> DataFrame:
    """A scan as images for ``tables.upsert``: each row counts as of its chunk's ``low`` position.

    Any change after that replaces it, whichever comes first; what the log says from the least
    ``low`` on must be applied.
    """
    return scan.withColumnRenamed(LOW, "seq").drop(HIGH)
