"""Event-time summaries, crash filter, log tags and probe levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import text, times

# Window of one day shifted by -8 hours (the same windows as a 16-hour offset).
DAY_WINDOW, DAY_OFFSET = "1 day", "16 hours"
LATENESS = "2 hours"
SUCCESS, FAILURE, REPLAY = "SUCCESS", "FAILURE", "replay"


def with_event_time(pods: DataFrame) -> DataFrame:
    return pods.withColumn("ts", times.from_epoch_seconds(F.col("job_start_timestamp")))


def not_successful(df: DataFrame, status: str = "status") -> DataFrame:
    """Everything but SUCCESS; a missing status counts as not successful."""
    return df.filter(~F.col(status).eqNullSafe(F.lit(SUCCESS)))


def failures_per_window(
    df: DataFrame, ts: str = "ts", key: str = "status",
    width: str = DAY_WINDOW, offset: str = DAY_OFFSET,
) -> DataFrame:
    """``(window_start, key, n)``; runs unchanged on a stream with a watermark on ``ts``."""
    return (
        not_successful(df, key)
        .groupBy(F.window(ts, width, width, offset), key).agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), key, "n")
    )


def tag_logs(df: DataFrame, log: str = "log") -> DataFrame:
    return df.withColumn("tag", text.first_match_tag(F.col(log)))


def probe_levels(df: DataFrame, output: str = "text") -> DataFrame:
    return df.withColumn("level", text.probe_level(F.col(output)))


def crashes(bags: DataFrame) -> DataFrame:
    """Failed replays with a backtrace (an empty one counts)."""
    return bags.filter(
        (F.col("type") == REPLAY) & (F.col("status") == FAILURE) & F.col("backtrace").isNotNull())
