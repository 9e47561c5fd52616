"""Daily bag statistics: replayed duration by mode and group, and nested error counts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import nested, payload, text
from fleetpulse.operators.days import open_days

# Statistic names and the record type they cover.
DURATION_BY_MODE = "stat_replay_success_bag_duration_group_by_mode"
DURATION_BY_GROUP = "stat_replay_success_bag_duration_group_by_category"
ERRORS_BY_GROUP = "stat_replay_error_bag_count_group_by_category"
REPLAY = "replay"
ALL_METRICS = (DURATION_BY_MODE, DURATION_BY_GROUP, ERRORS_BY_GROUP)


def reshape(
    messages: DataFrame, record_ts: str = "record_ts", extra: list[str] | None = None
) -> DataFrame:
    """Replay messages with the fields the metrics need; the day is that of the topic record."""
    kept = [c for c in ("seq",) if c in messages.columns] + (extra or [])
    return messages.filter(F.col("type") == REPLAY).select(
        *kept,
        F.date_trunc("second", F.col(record_ts)).cast("timestamp_ntz").alias("ts"),
        F.to_date(record_ts).alias("stat_date"),
        payload.mode_of(F.col("config")).alias("mode"),
        text.map_values(F.col("group"), text.GROUP_ALIASES).alias("group"),
        "error_stage", "error_type", "output_bag",
        payload.duration_of(F.col("metric")).alias("duration"),
    )


def deltas(bags: DataFrame, metrics: tuple[str, ...] = ALL_METRICS) -> DataFrame:
    """Long rows ``(stat_date, name, path, value)``, one or more per bag."""
    def key(name):
        return F.coalesce(F.col(name), F.lit("null"))

    has_output = ~F.col("output_bag").eqNullSafe(F.lit("")) & F.col("duration").isNotNull()
    has_error = ~F.col("error_type").eqNullSafe(F.lit(""))
    by_mode = has_output & F.coalesce(F.col("mode") != "", F.lit(False))
    candidates = {
        DURATION_BY_MODE: (by_mode, F.array(key("mode")), F.col("duration")),
        DURATION_BY_GROUP: (has_output, F.array(key("group")), F.col("duration")),
        ERRORS_BY_GROUP: (
            has_error, F.array(key("group"), key("error_stage"), key("error_type")), F.lit(1.0)),
    }
    entries = [
        F.when(candidates[m][0], F.struct(
            F.lit(m).alias("name"), candidates[m][1].alias("path"),
            candidates[m][2].alias("value")))
        for m in metrics
    ]
    extra = [c for c in ("seq",) if c in bags.columns]
    return bags.select(*extra, "stat_date", F.inline(F.array_compact(F.array(*entries))))


def statistics(
    bags: DataFrame,
    metrics: tuple[str, ...] = ALL_METRICS,
    drop_late: bool = False,
    order: list[str] | None = None,
    as_of: date | None = None,
    prev_seen_day: bool = False,
) -> DataFrame:
    """``(stat_date, name, path, value)``; ``drop_late`` applies the open-day rule first."""
    if drop_late:
        bags = open_days(bags, order or ["seq"], as_of=as_of, prev_seen_day=prev_seen_day)
    return nested.add_at_path(deltas(bags, metrics), ["stat_date", "name"]).select(
        "stat_date", "name", "path", "value")
