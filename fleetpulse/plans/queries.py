"""Registered queries: whole-table inputs, one flat result each."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.functions import nested, times
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
from fleetpulse.operators.days import open_days
from fleetpulse.plans import fixtures as fx
from fleetpulse.sinks import topics as topic_sinks
from fleetpulse.sources import changes, topics

RANGE_START, RANGE_END = datetime(1997, 1, 1), datetime(1999, 1, 1)
AS_OF = date(1998, 7, 1)
PLAN_ROWS = 10
ZONE = "Asia/Tokyo"
SEED_DAY = date(2024, 1, 10)
RETAIN_AS_OF = date(1998, 9, 1)
# sequence numbers of many partitions are far apart
WIDE = 1_048_583


def _flat(stats: DataFrame) -> DataFrame:
    return stats.select(
        "stat_date", "name", F.array_join("path", ".").alias("key"),
        F.round("value", 4).alias("value"))


def _workflow_events(spark, sf_dir):
    return wf.reshape(fx.workflow_messages(spark, sf_dir))


def _late_events(spark, sf_dir):
    extra = fx.arrival().alias("arrival")
    return wf.reshape(fx.workflow_messages(spark, sf_dir, extra), ["arrival"])


def _bags(spark, sf_dir):
    return bag_stats.reshape(fx.bag_messages(spark, sf_dir))


def _bag_query(*metrics):
    return lambda spark, sf_dir: _flat(bag_stats.statistics(_bags(spark, sf_dir), metrics))


def _workflow_query(*metrics, **options):
    return lambda spark, sf_dir: _flat(
        wf.statistics(_workflow_events(spark, sf_dir), metrics, **options))


def bag_error_info(spark, sf_dir):
    return wf.records(bag_stats.statistics(_bags(spark, sf_dir), (bag_stats.ERRORS_BY_GROUP,)), 3)


def wf_counter_records(spark, sf_dir):
    return wf.records(wf.statistics(_workflow_events(spark, sf_dir), wf.COUNTERS), 1)


def wf_transitions(spark, sf_dir):
    rows = wf.transitions(wf.accepted_events(_workflow_events(spark, sf_dir)))
    return rows.select("stat_date", "workflow_id", "seq", "sign", "workflow_status",
                       "workflow_type")


def wf_late_drop(spark, sf_dir):
    kept = open_days(_late_events(spark, sf_dir), ["arrival", "seq"])
    return kept.select("seq", "stat_date", "is_today")


def wf_late_drop_prev_seen(spark, sf_dir):
    kept = open_days(_late_events(spark, sf_dir), ["arrival", "seq"], prev_seen_day=True)
    return kept.select("seq", "stat_date", "is_today")


def wf_late_statistics(spark, sf_dir):
    return _flat(wf.statistics(
        _late_events(spark, sf_dir), wf.COUNTERS, order=["arrival", "seq"],
        chunk=F.date_trunc("hour", "arrival"), late_dedupe=False, drop_late=True))


def fault_sessions(spark, sf_dir):
    return faults.fault_sessions(fx.node_messages(spark, sf_dir))


def fault_alerts(spark, sf_dir):
    return faults.alerts(fault_sessions(spark, sf_dir)).select(
        "cluster_name", "node_name", "fault_type", "level", "seq", "minutes", "info")


def fault_sessions_by_arrival(spark, sf_dir):
    """Sessions in the order of a later arrival, with large sequence numbers."""
    raw = fx.node_topic(fx.events(spark, sf_dir), fx.arrival().alias("arrival"))
    rows = topics.messages(raw, schemas.NODE_MESSAGE).withColumn("seq", F.col("seq") * WIDE)
    return faults.fault_sessions(rows, ["arrival", "seq"])


def wf_statistics_by_arrival(spark, sf_dir):
    events = _late_events(spark, sf_dir).withColumn("seq", F.col("seq") * WIDE)
    return _flat(wf.statistics(events, wf.COUNTERS, order=["arrival", "seq"]))


def wf_time_consuming_clash(spark, sf_dir):
    """Profiles whose layout changes from message to message."""
    raw = fx.workflow_topic(fx.events(spark, sf_dir), clash=True)
    events = wf.reshape(topics.messages(raw, schemas.WORKFLOW_MESSAGE))
    return _flat(wf.statistics(events, (wf.TIME_CONSUMING,)))


def wf_late_drop_seeded(spark, sf_dir):
    """Nothing before the day that the state was built anew, less one."""
    kept = open_days(_late_events(spark, sf_dir), ["arrival", "seq"], as_of=SEED_DAY)
    return kept.select("seq", "stat_date", "is_today")


def bag_last_duration(spark, sf_dir):
    """The last duration of each group and day instead of their sum."""
    rows = bag_stats.deltas(_bags(spark, sf_dir), (bag_stats.DURATION_BY_GROUP,))
    return _flat(nested.overwrite_at_path(rows, ["stat_date", "name"], "seq"))


def retention_as_of(spark, sf_dir):
    """Workflows that are kept on a given day."""
    kept = transfer.retained(
        fx.workflow_table(spark, sf_dir, category=False), fx.result_table(spark, sf_dir),
        *transfer.retention_bounds(RETAIN_AS_OF, transfer.KEEP_DAYS))
    return kept[0].select("workflow_id", "workflow_status", "create_time")


def node_routes(spark, sf_dir):
    return faults.levels(fx.node_messages(spark, sf_dir)).select("seq", "node_name", "route")


def _failures(spark, sf_dir):
    return bursts.failed_replays(fx.job_messages(spark, sf_dir))


def burst_windows(spark, sf_dir):
    return bursts.burst_windows(_failures(spark, sf_dir))


def burst_alerts(spark, sf_dir):
    return bursts.burst_alerts(burst_windows(spark, sf_dir))


def burst_results(spark, sf_dir):
    windows = burst_windows(spark, sf_dir)
    return bursts.window_results(windows, bursts.burst_alerts(windows)).select(
        "node_name", "window_start", "n", "outcome", "result")


def burst_actions(spark, sf_dir):
    failures = _failures(spark, sf_dir)
    alerts = bursts.burst_alerts(bursts.burst_windows(failures))
    return bursts.burst_actions(failures, alerts)


def burst_actions_clear_after(spark, sf_dir):
    failures = _failures(spark, sf_dir)
    alerts = bursts.burst_alerts(bursts.burst_windows(failures))
    return bursts.burst_actions(failures, alerts, clear_after=True)


def burst_action_records(spark, sf_dir):
    """One record per node, window and kind, with all its targets."""
    records = bursts.action_records(burst_actions(spark, sf_dir))
    return records.withColumn("targets", F.array_join("targets", ","))


def burst_alert_records(spark, sf_dir):
    """Alerts with their level, time and text; windows in the cooldown have none."""
    return bursts.alert_records(burst_alerts(spark, sf_dir)).select(
        "node_name", "window_start", "outcome", "level", "time", "info")


def failures_per_day_offset(spark, sf_dir):
    pods = summary.with_event_time(fx.pod_messages(spark, sf_dir))
    return summary.failures_per_window(pods).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz"))


def log_tags(spark, sf_dir):
    return summary.tag_logs(fx.read(spark, sf_dir, "documents"), "text").select("doc_id", "tag")


def probe_levels(spark, sf_dir):
    return summary.probe_levels(fx.probe_outputs(spark, sf_dir)).select("doc_id", "level")


def crash_filter(spark, sf_dir):
    """Crashes written as topic text and decoded again."""
    kept = summary.crashes(fx.bag_messages(spark, sf_dir)).drop("seq", "record_ts")
    return topics.messages(topic_sinks.to_json_rows(kept), schemas.BAG_MESSAGE).select(
        "result_id", "type", "status", "group", "error_type", "error_stage", "backtrace")


def cdc_latest(spark, sf_dir):
    log = changes.change_rows(fx.change_log(spark, sf_dir), schemas.WORKFLOW_TABLE)
    rows = replication.to_lake_workflow(replication.current_rows(log, ["workflow_id"]))
    return rows.select("workflow_id", "workflow_status", "_tag", "category", "create_time",
                       "upload_ttl", "bag_nums")


def cdc_snapshot_then_log(spark, sf_dir):
    log = changes.snapshot_then_changes(
        fx.workflow_table(spark, sf_dir, category=False), fx.change_log(spark, sf_dir),
        schemas.WORKFLOW_TABLE)
    return replication.current_rows(log, ["workflow_id"]).groupBy("workflow_status").agg(
        F.count("*").alias("n"), F.round(F.sum("upload_ttl"), 3).alias("ttl"))


def times_as_text(spark, sf_dir):
    rows = replication.times_as_text(
        fx.result_table(spark, sf_dir), ["create_time", "update_time"])
    return rows.select("id", "workflow_id_id", "create_time", "update_time")


def _parents(spark, sf_dir):
    chosen = transfer.in_range(F.col("create_time"), RANGE_START, RANGE_END)
    return fx.workflow_table(spark, sf_dir, category=False).filter(chosen)


def inner_child_rows(spark, sf_dir):
    rows = transfer.children_of(fx.result_table(spark, sf_dir), _parents(spark, sf_dir),
                                "workflow_id_id", "workflow_id")
    return rows.select("id", "workflow_id_id", "create_time", "log", "error_type")


def semi_child_rows(spark, sf_dir):
    rows = transfer.children_in(fx.result_table(spark, sf_dir), _parents(spark, sf_dir),
                                "workflow_id_id", "workflow_id")
    return rows.select("id", "workflow_id_id", "create_time", "log", "error_type")


def _copy(spark, sf_dir):
    return transfer.incremental(
        fx.workflow_table(spark, sf_dir, category=False), fx.result_table(spark, sf_dir), AS_OF)


def incremental_parents(spark, sf_dir):
    return replication.to_lake_workflow(_copy(spark, sf_dir)[0]).select(
        "workflow_id", "workflow_status", "_tag", "create_time", "upload_ttl")


def incremental_children(spark, sf_dir):
    return _copy(spark, sf_dir)[1].select("id", "workflow_id_id", "create_time", "log")


def range_plan(spark, sf_dir):
    seconds = transfer.histogram(fx.workflow_table(spark, sf_dir, category=False), "create_time")
    return transfer.range_plan(seconds, PLAN_ROWS, "month")


def range_rows(spark, sf_dir):
    table = fx.workflow_table(spark, sf_dir, category=False)
    seconds = transfer.labelled_seconds(
        transfer.histogram(table, "create_time"), PLAN_ROWS, "month")
    placed = transfer.assign_ranges(table, seconds, "create_time", ["workflow_id"])
    return placed.select("workflow_id", "range_start", "page")


def _kept(spark, sf_dir):
    return transfer.retained(
        fx.workflow_table(spark, sf_dir, category=False), fx.result_table(spark, sf_dir),
        RANGE_START, RANGE_END)


def retention_parents(spark, sf_dir):
    return _kept(spark, sf_dir)[0].select("workflow_id", "workflow_status", "create_time")


def retention_children(spark, sf_dir):
    return _kept(spark, sf_dir)[1].select("id", "workflow_id_id", "create_time", "log")


def recon_counts(spark, sf_dir):
    left = reconcile.bucket_counts(fx.workflow_table(spark, sf_dir, category=False), "create_time")
    right = reconcile.bucket_counts(fx.lake_copy(spark, sf_dir, category=False), "create_time")
    return reconcile.compare_counts(left, right)


def recon_child_counts(spark, sf_dir):
    """Children counted by their parent's day on one side, by their own day on the other."""
    children, parents = fx.result_table(spark, sf_dir), fx.workflow_table(spark, sf_dir, category=False)
    days = parents.select(F.col("workflow_id").alias("_pk"), F.col("create_time").alias("day"))
    joined = children.join(days, F.col("workflow_id_id") == F.col("_pk")).select("day")
    return reconcile.compare_counts(
        reconcile.bucket_counts(joined, "day"), reconcile.bucket_counts(children, "create_time"))


def recon_fields(spark, sf_dir):
    columns = schemas.WORKFLOW_TABLE.fieldNames()
    return reconcile.compare_fields(
        fx.workflow_table(spark, sf_dir), fx.lake_copy(spark, sf_dir), "workflow_id", columns,
        replication.LAKE_RENAMES, {"upload_ttl": replication.whole_number})


def recon_result_fields(spark, sf_dir):
    results = fx.numbered_results(spark, sf_dir)
    return reconcile.compare_fields(
        results, fx.altered_results(results), "id", schemas.RESULT_TABLE.fieldNames())


def bag_late_statistics(spark, sf_dir):
    """Bags whose day is still open when they arrive, in order of the late arrival."""
    events = fx.events(spark, sf_dir)
    raw = fx.bag_topic(events, fx.arrival().alias("arrival"))
    bags = bag_stats.reshape(topics.messages(raw, schemas.BAG_MESSAGE), extra=["arrival"])
    return _flat(bag_stats.statistics(bags, drop_late=True, order=["arrival", "seq"]))


def recon_stats(spark, sf_dir):
    stats = bag_stats.statistics(
        _bags(spark, sf_dir), (bag_stats.DURATION_BY_GROUP, bag_stats.DURATION_BY_MODE))
    left, right = wf.records(stats, 1), wf.records(fx.altered_statistics(stats), 1)
    window = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
    return reconcile.worst_last(reconcile.compare_totals(
        reconcile.totals(reconcile.daily_records(left, *window)),
        reconcile.totals(reconcile.daily_records(right, *window, skip_live=True))))


def recon_time_profile(spark, sf_dir):
    stats = wf.statistics(_workflow_events(spark, sf_dir), (wf.TIME_CONSUMING,))
    return reconcile.totals(wf.records(stats, 4)).select(
        "name", "key", F.round("value", 4).alias("value"))


def time_buckets(spark, sf_dir):
    ts = F.col("ts")
    return fx.read(spark, sf_dir, "events").select(
        "event_id",
        *[times.bucket(ts, u).alias(u) for u in times.UNITS],
        *[times.bucket_text(ts, u).alias(f"{u}_text") for u in times.UNITS],
        *[times.bucket_epoch(ts, u).alias(f"{u}_epoch") for u in times.UNITS],
        times.to_epoch(ts).alias("epoch"),
        times.parse_text(times.to_text(ts)).alias("parsed"),
        times.text_to_epoch(times.to_text(ts)).alias("parsed_epoch"),
        times.shift_zone(ts, "UTC", ZONE).alias("shifted"),
    )


def page_rows(spark, sf_dir):
    table = fx.workflow_table(spark, sf_dir, category=False).select("workflow_id", "create_time")
    return transfer.page(table, ["create_time", "workflow_id"], 100, 200)


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bag_duration_by_group": _bag_query(bag_stats.DURATION_BY_GROUP),
    "bag_duration_by_mode": _bag_query(bag_stats.DURATION_BY_MODE),
    "bag_error_nested": _bag_query(bag_stats.ERRORS_BY_GROUP),
    "bag_error_info": bag_error_info,
    "bag_late_statistics": bag_late_statistics,
    "bag_last_duration": bag_last_duration,
    "wf_transitions": wf_transitions,
    "wf_pods_by_type": _workflow_query(wf.SUCCESS_PODS, wf.FAILURE_PODS),
    "wf_pods_category_retraction": _workflow_query(
        wf.SUCCESS_PODS, wf.FAILURE_PODS, retract_key="category"),
    "wf_bags_by_category": _workflow_query(wf.REPLAY_OK_BY_CATEGORY, wf.REPLAY_BAD_BY_CATEGORY),
    "wf_bags_by_mode": _workflow_query(wf.REPLAY_OK_BY_MODE, wf.REPLAY_BAD_BY_MODE),
    "wf_bags_by_type": _workflow_query(wf.OK_BAGS_BY_TYPE, wf.BAD_BAGS_BY_TYPE),
    "wf_time_consuming": _workflow_query(wf.TIME_CONSUMING),
    "wf_daily_statistics": _workflow_query(*wf.ALL_METRICS),
    "wf_counter_records": wf_counter_records,
    "wf_late_drop": wf_late_drop,
    "wf_late_drop_prev_seen": wf_late_drop_prev_seen,
    "wf_late_statistics": wf_late_statistics,
    "wf_late_drop_seeded": wf_late_drop_seeded,
    "wf_statistics_by_arrival": wf_statistics_by_arrival,
    "wf_time_consuming_clash": wf_time_consuming_clash,
    "fault_sessions": fault_sessions,
    "fault_sessions_by_arrival": fault_sessions_by_arrival,
    "fault_alerts": fault_alerts,
    "node_routes": node_routes,
    "burst_windows": burst_windows,
    "burst_alerts": burst_alerts,
    "burst_results": burst_results,
    "burst_actions": burst_actions,
    "burst_actions_clear_after": burst_actions_clear_after,
    "burst_action_records": burst_action_records,
    "burst_alert_records": burst_alert_records,
    "failures_per_day_offset": failures_per_day_offset,
    "log_tags": log_tags,
    "probe_levels": probe_levels,
    "crash_filter": crash_filter,
    "cdc_latest": cdc_latest,
    "cdc_snapshot_then_log": cdc_snapshot_then_log,
    "times_as_text": times_as_text,
    "inner_child_rows": inner_child_rows,
    "semi_child_rows": semi_child_rows,
    "incremental_parents": incremental_parents,
    "incremental_children": incremental_children,
    "range_plan": range_plan,
    "range_rows": range_rows,
    "retention_parents": retention_parents,
    "retention_children": retention_children,
    "retention_as_of": retention_as_of,
    "recon_counts": recon_counts,
    "recon_child_counts": recon_child_counts,
    "recon_fields": recon_fields,
    "recon_result_fields": recon_result_fields,
    "recon_stats": recon_stats,
    "recon_time_profile": recon_time_profile,
    "time_buckets": time_buckets,
    "page_rows": page_rows,
}
