"""Event-time failure counts as a stream: windows close after the watermark, late rows are dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetpulse.operators import summary


def failures_per_window(pods: DataFrame, lateness: str = summary.LATENESS) -> DataFrame:
    timed = summary.with_event_time(pods).withWatermark("ts", lateness)
    return summary.failures_per_window(timed)
