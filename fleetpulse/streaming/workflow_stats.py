"""Daily workflow statistics as a stream.

State per (day, workflow) holds the last accepted event; its rows of change go to the statistics
store, one partition per micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor

from fleetpulse.functions import nested
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.operators.days import open_days
from fleetpulse.schemas import layout
from fleetpulse.sinks import stats

STATE_BOUND = "2 days"
REFRESH = "20 seconds"

_LAST = layout("workflow_status string, workflow_type string, category string")
_FIELDS = (
    "seq long, record_ts timestamp, stat_date date, workflow_id string, workflow_status string, workflow_type string, "
    "category string, device string, mode string, bag_nums long, n_ok long, n_bad long, "
    "profile string"
)
CHANGES = layout(f"{_FIELDS}, sign integer")
_COLUMNS = layout(_FIELDS).fieldNames()
_CHANGE = Row(*CHANGES.fieldNames())


class StatusChanges(StatefulProcessor):
    """+1 for an accepted event, -1 for the event it takes back, 0 for a repeated status.

    Events of other statuses pass with +1: they change no counter, but their profiles count.
    """

    def __init__(self, zone: str):
        self._zone = zone

    def init(self, handle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", _LAST)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self._last.get() if self._last.exists() else None
        if last is None:
            # the day can be neither today nor yesterday once the watermark has passed its start
            self._handle.registerTimer(_millis(key[0], self._zone) + 1)
        for row in sorted(rows, key=_arrival):
            fields = tuple(row[c] for c in _COLUMNS)
            status = row["workflow_status"]
            if status not in wf.DECIDED:
                yield _CHANGE(*fields, 1)
                continue
            if last is not None and last[0] == status:
                yield _CHANGE(*fields, 0)
                continue
            yield _CHANGE(*fields, 1)
            if last is not None:
                back = dict(zip(_COLUMNS, fields))
                back.update(workflow_status=last[0], workflow_type=last[1], category=last[2])
                yield _CHANGE(*(back[c] for c in _COLUMNS), -1)
            last = (status, row["workflow_type"], row["category"])
        if last is not None:
            self._last.update(tuple(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def _arrival(row) -> tuple:
    return row["record_ts"] or datetime.min, row["seq"]


def _millis(day: date, zone: str) -> int:
    """The start of the day in the session's zone, in which ``stat_date`` is cut too."""
    start = datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone))
    return int(start.timestamp() * 1000)


def status_changes(events: DataFrame) -> DataFrame:
    """``events`` is a streaming :func:`wf.reshape`; rows older than two days are dropped.

    With ``record_ts`` (needed where a topic has several partitions) the arrival order is by it, then
    by ``seq``; without, by ``seq`` alone.
    """
    if "record_ts" not in events.columns:
        events = events.withColumn("record_ts", F.lit(None).cast("timestamp"))
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", STATE_BOUND)
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    return timed.select(*_COLUMNS, "ts").groupBy(*wf.KEYS).transformWithState(
        StatusChanges(zone), CHANGES, "Append", "EventTime")


def change_deltas(changes: DataFrame, retract_key: str = "type") -> DataFrame:
    """Long delta rows of a batch of changes: eight counters and the profile leaves.

    Profile leaves are added up as they come; a change of a profile's layout is resolved only by
    the batch operator.
    """
    counters = wf.counter_deltas(changes.filter("sign <> 0"), wf.COUNTERS, retract_key)
    leaves = (
        nested.explode_nodes(
            changes.filter((F.col("sign") == 1) & (F.col("workflow_type") == wf.REPLAY)),
            "profile", ["seq", "stat_date", "device", "category"])
        .filter(F.col("kind") == "number")
    )
    place = F.array(F.coalesce("device", F.lit("null")), F.coalesce("category", F.lit("null")))
    return counters.unionByName(leaves.select(
        "seq", "stat_date", F.lit(wf.TIME_CONSUMING).alias("name"),
        F.concat(place, F.col("path")).alias("path"), "value"))


def arrival_order(events: DataFrame) -> list[str]:
    return ["record_ts", "seq"] if "record_ts" in events.columns else ["seq"]


def open_rows(
    batch: DataFrame, store: str, batch_id: int, as_of: date | None = None, run: int = 0,
    order: list[str] | None = None,
) -> DataFrame:
    """The rows of a micro-batch whose day is open, given the newest day of earlier batches."""
    known = [d for d in (stats.newest_day(batch.sparkSession, store, batch_id, run), as_of) if d]
    return open_days(batch, order or ["seq"], as_of=max(known) if known else None)


def write_changes(
    store: str, as_of: date | None = None, to_deltas=change_deltas, run: int = 0,
    records: str | None = None, order: list[str] | None = None,
):
    """foreachBatch function: open days only, then deltas, the newest day, and the days' records."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            at = stats.arrival(rows)
            newest, first, last = rows.agg(F.max("stat_date"), F.min(at), F.max(at)).first()
            if newest is None:
                return
            kept = open_rows(rows, store, batch_id, as_of, run, order)
            # deltas hand the column seq on: the hour of arrival takes its place
            deltas = to_deltas(kept.withColumn("seq", F.date_trunc("hour", at)))
            stats.write_deltas(deltas.withColumnRenamed("seq", stats.HOUR), store, batch_id, run)
            stats.write_progress(batch.sparkSession, store, batch_id, newest, first, last, run)
            if records:
                # at most the two open days of each day that the batch saw as today
                days = [r[0] for r in kept.select("stat_date").distinct().collect()]
                stats.publish(batch.sparkSession, store, records, days)
        finally:
            rows.unpersist()
    return apply


def statistics_stream(
    events: DataFrame, store: str, checkpoint: str, as_of: date | None = None,
    retract_key: str = "type", records: str | None = None, start: datetime | None = None,
) -> DataStreamWriter:
    """Deltas into ``store`` and, if given, the records of every touched day into ``records``.

    ``start`` is the record time from which ``events`` begin, if that was set.
    """
    run = stats.run_of(events.sparkSession, store, checkpoint, start)
    write = write_changes(
        store, as_of, lambda rows: change_deltas(rows, retract_key), run, records,
        arrival_order(events))
    return (
        status_changes(events).writeStream.outputMode("append").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
