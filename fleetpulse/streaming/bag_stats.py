"""Daily bag statistics as a stream: no state, one partition of summed deltas per micro-batch."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from fleetpulse.operators import bag_stats
from fleetpulse.sinks import stats
from fleetpulse.streaming.workflow_stats import arrival_order, write_changes


def statistics_stream(
    bags: DataFrame, store: str, checkpoint: str, as_of: date | None = None,
    records: str | None = None, start: datetime | None = None,
) -> DataStreamWriter:
    """``bags`` is a streaming :func:`bag_stats.reshape` with ``seq``."""
    run = stats.run_of(bags.sparkSession, store, checkpoint, start)
    write = write_changes(store, as_of, bag_stats.deltas, run, records, arrival_order(bags))
    return (
        bags.writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
