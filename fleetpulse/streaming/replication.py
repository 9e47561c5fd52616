"""Continuous copy of a change log into a lake table; deletes are ignored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from fleetpulse.operators import replication
from fleetpulse.sinks import tables

COMMIT = "30 seconds"


def replicate(
    changes: DataFrame,
    target: str,
    keys: list[str],
    checkpoint: str,
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataStreamWriter:
    """``changes`` is a stream of change rows; ``shape`` brings rows to the lake's layout.

    The target keeps ``seq``, so a replayed or older change never replaces a newer row.
    """
    flat = replication.images(changes).select("seq", "row.*")

    def apply(batch: DataFrame, batch_id: int) -> None:
        tables.upsert(shape(batch), target, keys, "seq")

    return (
        flat.writeStream.outputMode("append").foreachBatch(tables.each_batch(apply))
        .option("checkpointLocation", checkpoint)
    )
