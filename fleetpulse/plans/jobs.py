"""The whole jobs: source, operators, sink. Addresses, tables and folders are parameters.

Streaming jobs return writers; the caller picks the trigger and starts them. Batch jobs take
``as_of`` and can be run again: each writes whole partitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from fleetpulse import schemas
from fleetpulse.functions import times
from fleetpulse.operators import (
    bag_stats,
    bursts,
    faults,
    reconcile,
    replication,
    summary,
    transfer,
)
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.session import checkpoint_root
from fleetpulse.sinks import tables
from fleetpulse.sinks import topics as topic_sinks
from fleetpulse.sources import changes, jdbc, lake, topics
from fleetpulse.sources.keyed import Files
from fleetpulse.streaming import bag_stats as bag_stream
from fleetpulse.streaming import bursts as burst_stream
from fleetpulse.streaming import faults as fault_stream
from fleetpulse.streaming import replication as replication_stream
from fleetpulse.streaming import summary as summary_stream
from fleetpulse.streaming import workflow_stats as wf_stream


@dataclass(frozen=True)
class Topic:
    """A Kafka topic (``servers`` given) or a folder of JSON files.

    A stream takes at most ``batch_rows`` records, of a folder ``files_per_trigger`` files, at a time;
    the rest waits for the next micro-batch. The stream processors put one key's records of one
    micro-batch in order in memory, so this also bounds what a hot key can bring to one task.
    """

    name: str
    servers: str | None = None
    start: datetime | str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    files_per_trigger: int = 64
    batch_rows: int = 2_000_000

    def read(self, spark: SparkSession, stream: bool = True) -> DataFrame:
        if self.servers:
            limit = {"maxOffsetsPerTrigger": str(self.batch_rows)} if stream else {}
            return topics.kafka_topic(
                spark, self.servers, self.name, self.start, {**limit, **self.options}, stream)
        return topics.file_topic(spark, self.name, self.start_time, self.files_per_trigger, stream)

    @property
    def start_time(self) -> datetime | None:
        """The record time from which the topic is read, if it is a time."""
        return self.start if isinstance(self.start, datetime) else None


def day_before(as_of: date) -> datetime:
    """Where a statistics stream starts when its state is built anew: yesterday, midnight."""
    return datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=1)


def start(writer: DataStreamWriter, every: str | None = None) -> StreamingQuery:
    """Run a stream: at an interval (``wf_stream.REFRESH``, ``replication_stream.COMMIT``), or over
    what is there now and then stop."""
    if every:
        return writer.trigger(processingTime=every).start()
    return writer.trigger(availableNow=True).start()


def decoded_table(
    spark: SparkSession, topic: Topic, schema: StructType, target: str, rejects: str
) -> None:
    """Decode a topic once into a table by record day, for batch jobs that read it several times.

    The topic is read once, into the checkpoint folder, so that both tables are of the same records.
    """
    spark.sparkContext.setCheckpointDir(checkpoint_root(spark, f"{rejects}-reading"))
    rows = topics.decode(topic.read(spark, stream=False), schema).checkpoint()
    tables.overwrite_days(topics.good(rows), target, "record_ts")
    tables.overwrite_parts(topics.corrupt(rows).withColumn("day", F.to_date("record_ts")),
                           rejects, ["day"])


def message_rejects(
    spark: SparkSession, topic: Topic, schema: StructType, target: str, checkpoint: str,
    time_field: str | None = None, read_time: Callable[[Column], Column] = times.parse_text,
) -> DataStreamWriter:
    """What the jobs on a topic leave out, with the reason: malformed and badly timed messages.

    To be run beside each of them: its rows and theirs together are all rows of the topic.
    ``time_field`` is the field that the job goes by, ``read_time`` how it reads it (see
    ``MESSAGE_TIMES``).
    """
    rows = topics.decode(topic.read(spark), schema)
    return _to_table(topics.rejects(rows, time_field, read_time), target, checkpoint)


#: The time field of each kind of message whose job goes by one, and how it is read.
MESSAGE_TIMES = {
    "workflow": ("update_time", times.parse_text),
    "job": ("timestamp", times.from_epoch_millis_text),
    "node": ("timestamp", times.from_epoch_seconds),
    "pod": ("job_start_timestamp", times.from_epoch_seconds),
}


def workflow_statistics(
    spark: SparkSession, topic: Topic, store: str, checkpoint: str, as_of: date | None = None,
    records: str | None = None,
) -> DataStreamWriter:
    """Deltas to ``store``; with ``records`` also one record per statistic and day there."""
    rows = topics.messages(topic.read(spark), schemas.WORKFLOW_MESSAGE)
    return wf_stream.statistics_stream(
        wf.reshape(rows, ["record_ts"]), store, checkpoint, as_of, records=records,
        start=topic.start_time)


def bag_statistics(
    spark: SparkSession, topic: Topic, store: str, checkpoint: str, as_of: date | None = None,
    records: str | None = None,
) -> DataStreamWriter:
    rows = topics.messages(topic.read(spark), schemas.BAG_MESSAGE)
    return bag_stream.statistics_stream(
        bag_stats.reshape(rows, extra=["record_ts"]), store, checkpoint, as_of, records,
        topic.start_time)


def _to_table(df: DataFrame, target: str, checkpoint: str) -> DataStreamWriter:
    write = tables.each_batch(lambda batch, n: tables.write_batch(batch, target, n))
    return (df.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint))


def node_monitor(
    spark: SparkSession, topic: Topic, alerts: str, checkpoint: str
) -> DataStreamWriter:
    """Alert records when faults open and close."""
    rows = topics.messages(topic.read(spark), schemas.NODE_MESSAGE)
    return _to_table(fault_stream.alerts(fault_stream.fault_events(rows)), alerts, checkpoint)


def node_rejects(
    spark: SparkSession, topic: Topic, rejects: str, checkpoint: str
) -> DataStreamWriter:
    """Node messages of an unknown level."""
    _, unknown = faults.route(topics.messages(topic.read(spark), schemas.NODE_MESSAGE))
    return _to_table(unknown, rejects, checkpoint)


def burst_monitor(
    spark: SparkSession, topic: Topic, alerts: str, actions: str, checkpoint: str,
    processing_time: bool = False, clear_after: bool = False, lateness: str = "10 minutes",
) -> DataStreamWriter:
    """Alert and action records.

    ``processing_time`` windows rows by when they are read and judges a window when the clock passes
    its end: start it at an interval. By event time a window is judged ``lateness`` after its end, and what comes later still is not
    counted: make it longer than partitions drift apart when the topic is caught up on.
    """
    failures = bursts.failed_replays(topics.messages(topic.read(spark), schemas.JOB_MESSAGE))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            tables.write_batch(bursts.alert_records(burst_stream.alerts(rows)), alerts, batch_id)
            todo = bursts.action_records(burst_stream.actions(rows))
            tables.write_batch(todo.withColumn("priority", F.when(
                F.col("kind") == "raise_priority", bursts.RAISED_PRIORITY)), actions, batch_id)
        finally:
            rows.unpersist()

    if processing_time:
        events = burst_stream.burst_events_by_clock(failures, clear_after=clear_after)
    else:
        events = burst_stream.burst_events(failures, lateness, clear_after=clear_after)
    return (events.writeStream.outputMode("append").foreachBatch(tables.each_batch(write))
            .option("checkpointLocation", checkpoint))


def crash_topic(
    spark: SparkSession, topic: Topic, checkpoint: str, path: str | None = None,
    kafka: Mapping[str, str] | None = None,
) -> DataStreamWriter:
    """Crashed replays as JSON text to another topic."""
    rows = topics.messages(topic.read(spark), schemas.BAG_MESSAGE)
    kept = summary.crashes(rows).select(*schemas.BAG_MESSAGE.fieldNames())
    return topic_sinks.stream_json(kept, checkpoint, path, kafka)


def replicate_workflows(
    spark: SparkSession, topic: Topic, target: str, checkpoint: str
) -> DataStreamWriter:
    log = changes.change_rows(topic.read(spark), schemas.WORKFLOW_TABLE)
    return replication_stream.replicate(
        log, target, ["workflow_id"], checkpoint, replication.to_lake_workflow)


def replicate_results(
    spark: SparkSession, topic: Topic, target: str, checkpoint: str
) -> DataStreamWriter:
    log = changes.change_rows(topic.read(spark), schemas.RESULT_TABLE)
    return replication_stream.replicate(log, target, ["id"], checkpoint)


def pod_failures(
    spark: SparkSession, topic: Topic, target: str, checkpoint: str
) -> DataStreamWriter:
    pods = topics.messages(topic.read(spark), schemas.POD_MESSAGE)
    return _to_table(summary_stream.failures_per_window(pods), target, checkpoint)


def pod_log_tags(
    spark: SparkSession, topic: Topic, target: str, checkpoint: str
) -> DataStreamWriter:
    pods = topics.messages(topic.read(spark), schemas.POD_MESSAGE)
    return _to_table(summary.tag_logs(pods), target, checkpoint)


#: Ranges of one day that a back-fill plans at most.
DAY_RANGES = 20_000


@dataclass(frozen=True)
class Backfill:
    """A table (or join) read over JDBC by ranges of ``time``.

    ``source`` and ``columns`` are the source's SQL; ``time`` is its time column and ``second`` its
    expression for the start of a second. ``page`` is a stable hash of the key modulo ``{pages}``.
    ``plan_time`` is the column of the result that holds ``time``; its day is the partition.
    """

    url: str
    properties: Mapping[str, str]
    source: str
    columns: str
    time: str
    second: str
    page: str
    plan_time: str
    not_null: tuple[str, ...] = ()

    def histogram(self, spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
        a, b = start.strftime(jdbc.TIME_LITERAL), end.strftime(jdbc.TIME_LITERAL)
        where = f"{self.time} >= '{a}' AND {self.time} < '{b}'"
        query = jdbc.histogram_query(self.source, self.time, self.second, where)
        opts = jdbc.jdbc_options(self.url, self.properties)
        return jdbc.table(spark, opts, query).select(
            F.col("second").cast("timestamp_ntz").alias("second"), F.col("n").cast("bigint"))

    def read(self, spark: SparkSession, predicates: list[str]) -> DataFrame:
        query = f"(SELECT {self.columns} FROM {self.source}) t"
        return jdbc.ranged_table(spark, self.url, query, self.properties, predicates)


_STATES = "day date, n bigint, state string, span string"
PLANNED, WRITTEN, VERIFIED = "planned", "written", "verified"


def _mark(spark: SparkSession, states: str, span: str, days: dict[date, int], state: str) -> None:
    rows = [(day, n, state, span, str(day)) for day, n in days.items()]
    if rows:
        tables.overwrite_parts(
            spark.createDataFrame(rows, f"{_STATES}, part string"), states, ["span", "part"])


def _finished(spark: SparkSession, states: str, span: str, planned: dict[date, int]) -> set[date]:
    """Days that an unfinished run of the span has copied, as far as their counts are the same.

    Where the last run was verified to its end, none: a new run copies all days again.
    """
    if not Files(spark, states).exists(""):
        return set()
    known = spark.read.schema(f"{_STATES}, part string").parquet(states).filter(
        F.col("span") == span).select("day", "n", "state").collect()
    if all(r.state == VERIFIED for r in known):
        return set()
    return {r.day for r in known if r.state != PLANNED and planned.get(r.day) == r.n}


def backfill(
    spark: SparkSession,
    source: Backfill,
    start: date,
    end: date,
    target: str,
    log: str,
    rows: int = transfer.RANGE_ROWS,
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Copy the days of [start, end) in bounded ranges; returns the run log of these days.

    The histogram is read once and kept in the checkpoint folder, so the plan and the log are of the
    same counts. Days are copied one after another: the driver holds one day's ranges, at most
    ``DAY_RANGES`` of them (on days with more rows than those can hold, ranges are larger). One task
    per range; a failed task is tried again by Spark.

    Each day has a state beside the log: planned, written, verified. A run that was stopped, or whose
    days differ from the plan, goes on with the days that are not yet written; one after a verified
    run replaces all days. Days without rows in the source are emptied.
    """
    spark.sparkContext.setCheckpointDir(checkpoint_root(spark, f"{log}-reading"))
    first, last = (datetime(d.year, d.month, d.day) for d in (start, end))
    per_second = source.histogram(spark, first, last).checkpoint()
    day = F.to_date("second")
    found = dict(tuple(r) for r in per_second.groupBy(day).agg(F.sum("n")).collect())
    span = [start + timedelta(days=k) for k in range((end - start).days)]
    planned = {d: found.get(d, 0) for d in span}
    states, name = f"{log}-states", f"{start}_{end}"
    done = _finished(spark, states, name, planned)
    _mark(spark, states, name, {d: n for d, n in planned.items() if d not in done}, PLANNED)
    for at, n in planned.items():
        if at in done:
            continue
        if n:
            plan = transfer.range_plan(
                per_second.filter(day == F.lit(at)), max(rows, -(-n // DAY_RANGES))).collect()
            read = source.read(spark, jdbc.range_predicates(plan, source.plan_time, source.page))
            checked = transfer.require_not_null(read, list(source.not_null))
            tables.overwrite_days(shape(checked), target, source.plan_time)
        else:
            tables.drop_days(spark, target, "day", [at])
        _mark(spark, states, name, {at: n}, WRITTEN)
    kept, differ = _logged(spark, per_second, target, log, start, end)
    _mark(spark, states, name, {d: n for d, n in planned.items() if d in differ}, PLANNED)
    _raise_on(differ, target, log)
    _mark(spark, states, name, planned, VERIFIED)
    return kept


def _raise_on(differ: set[date], target: str, log: str) -> None:
    if differ:
        raise RuntimeError(f"{len(differ)} days differ between the plan and {target}; see {log}")


def log_days(
    spark: SparkSession, per_second: DataFrame, target: str, log: str, start: date, end: date
) -> DataFrame:
    """Planned and written rows per day, kept in a log table; a difference raises."""
    kept, differ = _logged(spark, per_second, target, log, start, end)
    _raise_on(differ, target, log)
    return kept


def _logged(
    spark: SparkSession, per_second: DataFrame, target: str, log: str, start: date, end: date
) -> tuple[DataFrame, set[date]]:
    """The log of the days, and the days whose counts differ."""
    planned = per_second.groupBy(F.date_trunc("day", "second").cast("timestamp_ntz").alias(
        "bucket")).agg(F.sum("n").alias("n"))
    inside = (F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(end))
    written = lake.lake_table(spark, target).filter(inside).groupBy(
        F.col("day").cast("timestamp_ntz").alias("bucket")).agg(F.count("*").alias("n"))
    runs = reconcile.compare_counts(planned, written).withColumn("day", F.to_date("bucket"))
    days = [start + timedelta(days=k) for k in range((end - start).days)]
    tables.overwrite_parts(runs, log, ["day"])
    # a day with rows neither here nor there has no line, also if it had one before
    tables.empty_days(spark, log, "day", runs, days)
    kept = lake.lake_table(spark, log).filter(inside)
    return kept, {r[0] for r in kept.filter(~F.col("match")).select("day").collect()}


def daily_copy(
    parents: DataFrame, children: DataFrame, parent_target: str, child_target: str,
    as_of: date, lag_days: int = transfer.COPY_LAG_DAYS,
) -> None:
    """One day's workflows and their results; both tables are partitioned by the parents' day."""
    chosen, kids = transfer.incremental(parents, children, as_of, lag_days)
    start, _ = transfer.day_bounds(as_of, lag_days)
    for rows, target in ((kids, child_target),
                         (replication.to_lake_workflow(chosen), parent_target)):
        dated = rows.withColumn("day", F.lit(start).cast("date"))
        tables.overwrite_parts(dated, target, ["day"])
        tables.empty_days(dated.sparkSession, target, "day", dated, [start.date()])


def full_copy(children: DataFrame, target: str) -> None:
    """The whole results table, times as text."""
    dated = children.withColumn("day", F.to_date("create_time")).hint("rebalance", "day")
    text = replication.times_as_text(dated, ["create_time", "update_time"])
    tables.overwrite_parts(text, target, ["day"])


@dataclass(frozen=True)
class Source:
    """A table (or join) of a database, read in parallel by equal parts of its ``time``.

    ``source`` and ``columns`` are the source's SQL. ``part_rows`` is what one task reads where rows
    are spread evenly over time.
    """

    url: str
    properties: Mapping[str, str]
    source: str
    columns: str
    time: str
    part_rows: int = 1_000_000

    def _options(self) -> dict[str, str]:
        return jdbc.jdbc_options(self.url, self.properties)

    def count(self, spark: SparkSession) -> int:
        return jdbc.count_rows(spark, self._options(), jdbc.count_query(self.source))

    def whole(self, spark: SparkSession) -> DataFrame:
        """All rows: one task for each ``part_rows`` of them, by equal parts of the time span."""
        query = f"(SELECT {self.columns} FROM {self.source}) t"
        parts = -(-self.count(spark) // self.part_rows)
        span = jdbc.table(spark, self._options(), jdbc.bounds_query(self.source, self.time)).first()
        if parts < 2 or span is None or span["lower"] is None:
            return jdbc.table(spark, self._options(), query)
        lower, upper = (span[c].strftime(jdbc.TIME_LITERAL) for c in ("lower", "upper"))
        column = self.time.rsplit(".", 1)[-1]
        return jdbc.split_table(spark, self._options(), query, column, lower, upper, parts)

    def day(self, spark: SparkSession, as_of: date, lag_days: int) -> DataFrame:
        """The rows of one day; the range and the join run at the source."""
        first, last = transfer.day_bounds(as_of, lag_days)
        return jdbc.table(spark, self._options(), jdbc.range_query(
            self.columns, self.source, self.time, first, last))


def full_copy_from(spark: SparkSession, source: Source, target: str) -> DataFrame:
    """``full_copy`` out of a database; the counts of both sides after it, with ``match``."""
    full_copy(source.whole(spark), target)
    return spark.createDataFrame(
        [(source.count(spark), lake.lake_table(spark, target).count())],
        "n_source bigint, n_target bigint").withColumn(
        "match", F.col("n_source") == F.col("n_target"))


def daily_copy_from(
    spark: SparkSession, parents: Source, children: Source, parent_target: str, child_target: str,
    as_of: date, lag_days: int = transfer.COPY_LAG_DAYS,
) -> None:
    """``daily_copy`` out of a database: ``children`` is the join with its parents, by their time."""
    daily_copy(parents.day(spark, as_of, lag_days), children.day(spark, as_of, lag_days),
               parent_target, child_target, as_of, lag_days)


def retention(
    spark: SparkSession, parent_table: str, child_table: str, as_of: date,
    staging: str | None = None, keep_days: int = transfer.KEEP_DAYS,
    parts: tuple[str, ...] | list[str] = ("day",),
) -> None:
    """Delete the workflows of the day that left the retention period, results first.

    A repeated run finds the workflows that are still there: they go last, once all their results are
    gone. Within a run their ids are read once, into the staging folder. ``parts`` are the partitions
    of a copied folder; a replicated one needs none.
    """
    start, end = transfer.retention_bounds(as_of, keep_days)
    old = transfer.in_range(F.col("create_time"), start, end)
    ids = lake.lake_table(spark, parent_table).filter(old).select("workflow_id")
    if staging:
        chosen = f"{staging}/ids/{as_of}-{uuid.uuid4().hex}"
        ids.write.parquet(chosen)
        ids = spark.read.parquet(chosen)
    tables.delete_keys(
        spark, child_table, ids.select(F.col("workflow_id").alias("workflow_id_id")),
        "workflow_id_id", list(parts), staging and f"{staging}/children")
    tables.delete_keys(
        spark, parent_table, ids, "workflow_id", list(parts), staging and f"{staging}/parents")


def check_counts(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str
) -> DataFrame:
    return reconcile.compare_counts(
        reconcile.bucket_counts(left, left_time), reconcile.bucket_counts(right, right_time))


def check_workflows(source: DataFrame, copy: DataFrame) -> DataFrame:
    """All 22 columns; the rounded one is compared after rounding."""
    return reconcile.compare_fields(
        source, copy, "workflow_id", schemas.WORKFLOW_TABLE.fieldNames(),
        replication.LAKE_RENAMES, {"upload_ttl": replication.whole_number})


def check_results(source: DataFrame, copy: DataFrame) -> DataFrame:
    return reconcile.compare_fields(source, copy, "id", schemas.RESULT_TABLE.fieldNames())


def check_statistics_tables(
    spark: SparkSession, left: str, right: str, start: str, end: str
) -> DataFrame:
    """``check_statistics`` of the statistics tables of two environments, by name or path."""
    return check_statistics(
        lake.lake_table(spark, left), lake.lake_table(spark, right), start, end)


def check_statistics(left: DataFrame, right: DataFrame, start: str, end: str) -> DataFrame:
    """Two environments' daily statistics of a date range, largest surplus last."""
    return reconcile.worst_last(reconcile.compare_totals(
        reconcile.totals(reconcile.daily_records(left, start, end)),
        reconcile.totals(reconcile.daily_records(right, start, end, skip_live=True))))
