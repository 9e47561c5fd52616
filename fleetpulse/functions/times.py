"""Time conversions and buckets. Text is local wall-clock time, so it maps to TIMESTAMP_NTZ."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text format of every time field in messages and reports.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

_TEXT_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

UNITS = ("minute", "day", "week", "month")


def parse_text(c: Column) -> Column:
    """The time a text states; null where the text is not of the format or no such time exists."""
    return F.when(c.rlike(_TEXT_SHAPE), c.try_cast("timestamp_ntz"))


def to_text(ts: Column) -> Column:
    return F.date_format(ts, TEXT_FORMAT)


def to_epoch(ts: Column) -> Column:
    """Whole epoch seconds of a wall-clock or zoned time, in the session zone."""
    return F.unix_timestamp(ts.cast("timestamp"))


def text_to_epoch(c: Column) -> Column:
    return to_epoch(parse_text(c))


def bucket(ts: Column, unit: str) -> Column:
    """Start of the minute, day, week (Monday) or month, as TIMESTAMP_NTZ."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def bucket_text(ts: Column, unit: str) -> Column:
    return to_text(bucket(ts, unit))


def bucket_epoch(ts: Column, unit: str) -> Column:
    return to_epoch(bucket(ts, unit))


def from_epoch_millis_text(c: Column) -> Column:
    return F.timestamp_millis(c.try_cast("bigint"))


def from_epoch_seconds(c: Column) -> Column:
    """Fractional epoch seconds, cut to milliseconds; null where they are no time."""
    return F.timestamp_millis((c * 1000).try_cast("bigint"))


def epoch_seconds(ts: Column) -> Column:
    """Fractional epoch seconds (double), microseconds kept."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def shift_zone(ts: Column, source_zone: str, target_zone: str) -> Column:
    """Wall-clock time in one zone expressed as wall-clock time in another."""
    return F.convert_timezone(F.lit(source_zone), F.lit(target_zone), ts.cast("timestamp_ntz"))
