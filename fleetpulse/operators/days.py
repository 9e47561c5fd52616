"""Which calendar days are open when a record arrives: the newest day seen, and the one before."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Factor that makes room for a 63-bit sequence number behind a time in microseconds.
_ROOM = 2**63


def arrival_number(df: DataFrame, order: list[str]) -> Column:
    """The arrival order as one value: the column itself, or (time, sequence) as one decimal.

    A plain value keeps the minimum per day a hash aggregate; over a struct it would sort all rows.
    The second column must be a non-negative whole number.
    """
    if len(order) == 1:
        return F.col(order[0])
    first, second = order
    kind = df.schema[first].dataType.typeName()
    number = F.unix_micros(F.col(first).cast("timestamp")) if "timestamp" in kind else F.col(first)
    wide = number.cast("decimal(19,0)") * F.lit(Decimal(_ROOM)).cast("decimal(19,0)")
    return (wide + F.col(second).cast("decimal(19,0)")).cast("decimal(38,0)")


def open_days(
    df: DataFrame,
    order: list[str],
    day: str = "stat_date",
    as_of: date | None = None,
    prev_seen_day: bool = False,
) -> DataFrame:
    """Keep the records whose day is open on arrival; add ``is_today``.

    ``order`` is the total arrival order: one column, or a time and a sequence number. "Today" is
    the greatest day among the records up to and including this one (at least ``as_of``).
    "Yesterday" is the calendar day before it, or with ``prev_seen_day`` the day that was "today"
    before it.

    No running maximum over all records is needed: a day closes when the first record of a later
    day arrives, so one row per calendar day (its first arrival) decides every record. That table
    holds at most one row per calendar day, which is why it may be broadcast.
    """
    place = arrival_number(df, order)
    later = Window.orderBy(F.col("day_no").desc())

    firsts = df.groupBy(F.col(day).alias("day")).agg(F.min(place).alias("opened"))
    if as_of is not None:
        # the seed days exist even without records of their own
        seeds = df.sparkSession.range(2).select(
            F.date_sub(F.lit(as_of), F.col("id").cast("int")).alias("day"))
        firsts = firsts.join(seeds, "day", "full_outer")
        firsts = firsts.filter(F.col("day") >= F.date_sub(F.lit(as_of), 1))
    days = firsts.filter(F.col("day").isNotNull()).select(
        "day", "opened", F.unix_date("day").cast("bigint").alias("day_no"))
    days = days.withColumn(
        "closes", F.min("opened").over(later.rangeBetween(Window.unboundedPreceding, -1)))
    if prev_seen_day:
        was_today = F.col("closes").isNull() | (F.col("opened") < F.col("closes"))
        if as_of is not None:
            was_today = was_today | (F.col("day") <= F.lit(as_of))
        days = days.filter(was_today).withColumn(
            "expires", F.lag("closes").over(later))
    else:
        days = days.withColumn(
            "expires", F.min("opened").over(later.rangeBetween(Window.unboundedPreceding, -2)))

    is_today = F.col("closes").isNull() | (place < F.col("closes"))
    if as_of is not None:
        is_today = is_today & (F.col(day) >= F.lit(as_of))
    lookup = F.broadcast(days.select("day", "closes", "expires"))
    return (
        df.join(lookup, F.col(day) == F.col("day"), "inner")
        .filter(F.col("expires").isNull() | (place < F.col("expires")))
        .withColumn("is_today", is_today)
        .drop("day", "closes", "expires")
    )
