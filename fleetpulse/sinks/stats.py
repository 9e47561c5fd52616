"""The statistics table: one record per (name, 'daily', stat_date).

Streams write change rows ``(stat_date, hour, name, path, value)`` in one partition per day, run and
micro-batch; the statistics are their sum. A run is a checkpoint: its batch numbers count on from a
restart, so a repeated micro-batch replaces its own partition. A new checkpoint is a new run, which may
read again what an older one has read. Each run has a coverage interval, the record times between its
start and the last record it has seen, and each day is served by intervals that don't overlap:

* by the newest run whose interval covers the day whole, from its beginning to the end of the day after
  it (or to the last record that any run has seen, while that is earlier);
* where no run does, hour by hour of arrival: by a run that has read from the day's beginning if there
  is one, else by the one that began first (see ``served``).

So a run takes a day over only once it has read the day whole, and nothing is counted twice.
"""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.nested import add_at_path
from fleetpulse.operators.workflow_stats import records
from fleetpulse.sinks.tables import BATCH, append, overwrite_parts

STATE_DAYS = "days"
STATE_DELTAS = "deltas"
STATE_RUNS = "runs"
RUN = "run"
HOUR = "hour"

_RUNS = f"checkpoint string, {RUN} bigint, start timestamp"
_DAYS = f"newest_day date, first timestamp, last timestamp, {RUN} bigint, {BATCH} bigint"
_DELTAS = (f"{HOUR} timestamp, name string, path array<string>, value double, "
           f"stat_date date, {RUN} bigint, {BATCH} bigint")
_PARTS = ["stat_date", RUN, BATCH]


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def run_of(
    spark: SparkSession, store: str, checkpoint: str, start: datetime | None = None
) -> int:
    """The number of the run that has this checkpoint; a new checkpoint gets the next number.

    ``start`` is the record time from which a new run reads, if it was set; else its coverage begins
    with the first record that it sees.
    """
    known = _read(spark, f"{store}/{STATE_RUNS}", _RUNS)
    if known is not None:
        row = known.agg(F.max(RUN), F.max(F.when(
            F.col("checkpoint") == checkpoint, F.col(RUN)))).first()
        if row[1] is not None:
            return row[1]
    number = 0 if known is None else (row[0] or 0) + 1
    append(spark.createDataFrame([(checkpoint, number, start)], _RUNS), f"{store}/{STATE_RUNS}")
    return number


def _write(df: DataFrame, target: str, batch_id: int, run: int, parts: list[str]) -> None:
    overwrite_parts(df.withColumns({RUN: F.lit(run).cast("bigint"),
                                    BATCH: F.lit(batch_id).cast("bigint")}), target, parts)


def arrival(df: DataFrame) -> Column:
    """When a row arrived: its record time, or the beginning of its day where it has none."""
    day = F.col("stat_date").cast("timestamp")
    return F.coalesce(F.col("record_ts"), day) if "record_ts" in df.columns else day


def write_deltas(deltas: DataFrame, store: str, batch_id: int, run: int = 0) -> None:
    """Sum a micro-batch's deltas. ``hour`` is the hour of arrival; without it a row is of its
    day's first hour."""
    if HOUR not in deltas.columns:
        deltas = deltas.withColumn(HOUR, F.col("stat_date").cast("timestamp"))
    summed = add_at_path(deltas, ["stat_date", HOUR, "name"])
    _write(summed.select(HOUR, "name", "path", "value", "stat_date"),
           f"{store}/{STATE_DELTAS}", batch_id, run, _PARTS)


def write_progress(
    spark: SparkSession, store: str, batch_id: int, newest_day: date, first: datetime,
    last: datetime, run: int = 0,
) -> None:
    """What a micro-batch has seen: its newest day, and its first and last record times."""
    row = spark.createDataFrame(
        [(newest_day, first, last)], "newest_day date, first timestamp, last timestamp")
    _write(row, f"{store}/{STATE_DAYS}", batch_id, run, [RUN, BATCH])


def newest_day(spark: SparkSession, store: str, before_batch: int, run: int = 0):
    """The newest day that earlier micro-batches of the run have seen, or None."""
    rows = _read(spark, f"{store}/{STATE_DAYS}", _DAYS)
    if rows is None:
        return None
    return rows.filter((F.col(RUN) == run) & (F.col(BATCH) < before_batch)).agg(
        F.max("newest_day")).first()[0]


class Coverage(NamedTuple):
    """The record times that a run has read, in the session's zone as days are."""

    run: int
    first: datetime
    last: datetime


def coverages(spark: SparkSession, store: str) -> list[Coverage]:
    """The interval of every run, the newest first: one row per checkpoint."""
    seen = _read(spark, f"{store}/{STATE_DAYS}", _DAYS)
    if seen is None:
        return []
    seen = seen.groupBy(RUN).agg(F.min("first").alias("first"), F.max("last").alias("last"))
    runs = _read(spark, f"{store}/{STATE_RUNS}", _RUNS)
    if runs is not None:
        # several rows of one run only if its writer was repeated
        starts = runs.groupBy(RUN).agg(F.min("start").alias("start"))
        seen = seen.join(starts, RUN, "left").withColumn("first", F.least("start", "first"))
    wall = [F.col(c).cast("timestamp_ntz") for c in ("first", "last")]
    return [Coverage(*r) for r in seen.orderBy(F.desc(RUN)).select(RUN, *wall).collect()]


def _begins(runs: list[Coverage]) -> list[datetime]:
    """From when on each run has all there is: the hour of its first record, unless an older run
    began before that record; then, the record."""
    out = []
    for place, r in enumerate(runs):
        joined = any(o.first < r.first for o in runs[place + 1:])
        out.append(r.first if joined else r.first.replace(minute=0, second=0, microsecond=0))
    return out


def _of_hour(
    hour: datetime, begin: datetime, end: datetime, seen: datetime,
    runs: list[tuple[datetime, Coverage]],
) -> list[Coverage]:
    """The runs that serve what came in an hour; ``end`` is up to where a day must be read."""
    after = hour + timedelta(hours=1)
    covering = [(b, r) for b, r in runs if b <= hour and r.last >= min(after, seen)]
    whole = [r for b, r in covering if b <= begin]
    complete = [r for r in whole if r.last >= end]
    if complete:
        return complete[:1]
    if whole:
        return [max(whole, key=lambda r: (r.last, r.run))]
    if covering:
        return [min(covering, key=lambda x: (x[0], -x[1].run))[1]]
    # nobody has it all: the parts that don't overlap
    out: list[Coverage] = []
    for r in sorted((r for _, r in runs if r.first < after and r.last >= hour),
                    key=lambda r: r.first):
        if not out or r.first > out[-1].last:
            out.append(r)
    return out


def served(day: date, runs: list[Coverage]) -> list[tuple[int, datetime | None, datetime | None]]:
    """Which run serves which hours of arrival of a day: (run, from, to), None for no bound.

    ``runs`` are the newest first. Records of a day come on that day and the next. An hour goes to the
    newest run that has read the day whole; else, of those that have read from its beginning, to the one
    that has come furthest; else to the one that began first. In an hour that no run has read whole
    all parts count that don't overlap.
    """
    begin = datetime.combine(day, time())
    seen = max((r.last for r in runs), default=begin)
    end = min(begin + timedelta(days=2), seen)
    known = list(zip(_begins(runs), runs))
    parts: list[list] = []
    open_parts: dict[int, list] = {}
    hour = begin
    while hour < begin + timedelta(days=2) and hour <= max(seen, begin):
        after = hour + timedelta(hours=1)
        for r in _of_hour(hour, begin, end, seen, known):
            part = open_parts.get(r.run)
            if part is None or part[2] != hour:
                part = open_parts[r.run] = [r.run, hour, hour]
                parts.append(part)
            part[2] = after
        hour = after
    return [(run, None if since == begin else since, None if to == hour else to)
            for run, since, to in parts]


def _valid(spark: SparkSession, store: str, days: list | None = None) -> DataFrame:
    """The deltas that count, of some days or all."""
    deltas = spark.read.schema(_DELTAS).parquet(f"{store}/{STATE_DELTAS}")
    if days is not None:
        deltas = deltas.filter(F.col("stat_date").isin(days))
    else:
        days = [r[0] for r in deltas.select("stat_date").distinct().collect()]
    runs = coverages(spark, store)
    if len(runs) < 2:
        return deltas
    # one row for each day and run
    plan = spark.createDataFrame(
        [(day, *part) for day in days for part in served(day, runs)],
        "_day date, _run bigint, _from timestamp_ntz, _to timestamp_ntz")
    hour = F.col(HOUR).cast("timestamp_ntz")
    counts = ((F.col("stat_date") == F.col("_day")) & (F.col(RUN) == F.col("_run"))
              & F.coalesce(hour >= F.col("_from"), F.lit(True))
              & F.coalesce(hour < F.col("_to"), F.lit(True)))
    return deltas.join(plan, counts, "left_semi")


def read_statistics(spark: SparkSession, store: str, days: list | None = None) -> DataFrame:
    """The statistics of some days or all; of some days, only their partitions are read."""
    return add_at_path(_valid(spark, store, days), ["stat_date", "name"]).select(
        "stat_date", "name", "path", "value")


def compact(spark: SparkSession, store: str, fresh: str) -> None:
    """Sum a store's deltas into a new store, as batch -1 of their runs; the stream must be stopped.

    The new store knows the same runs, so a stream goes on there with the checkpoint it has. Every
    run keeps its rows: one that serves nothing yet may do so later.
    """
    deltas = spark.read.schema(_DELTAS).parquet(f"{store}/{STATE_DELTAS}")
    summed = add_at_path(deltas, ["stat_date", HOUR, "name", RUN]).withColumn(
        BATCH, F.lit(-1).cast("bigint"))
    overwrite_parts(summed.select(HOUR, "name", "path", "value", *_PARTS),
                    f"{fresh}/{STATE_DELTAS}", _PARTS)
    days = spark.read.schema(_DAYS).parquet(f"{store}/{STATE_DAYS}").groupBy(RUN).agg(
        F.max("newest_day").alias("newest_day"), F.min("first").alias("first"),
        F.max("last").alias("last")).withColumn(BATCH, F.lit(-1).cast("bigint"))
    overwrite_parts(days.select("newest_day", "first", "last", RUN, BATCH),
                    f"{fresh}/{STATE_DAYS}", [RUN, BATCH])
    runs = _read(spark, f"{store}/{STATE_RUNS}", _RUNS)
    if runs is not None:
        append(runs, f"{fresh}/{STATE_RUNS}")


def upsert_records(stats: DataFrame, target: str) -> None:
    """Statistics of whole days as records; each (day, statistic) replaces what was there."""
    overwrite_parts(records(stats), target, ["stat_date", "name"])


def publish(spark: SparkSession, store: str, target: str, days: list | None = None) -> None:
    """Upsert the records of the given days (default: all) of a store."""
    stats = read_statistics(spark, store, days)
    if not stats.isEmpty():
        upsert_records(stats, target)
