"""Each streaming form must give what the batch operator gives on the same records."""

import pytest
from helpers import memory, rows, run_available, write_topic
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.operators import bag_stats, bursts, faults, replication, summary
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.operators.days import open_days
from fleetpulse.plans import fixtures as fx
from fleetpulse.sinks import stats, tables
from fleetpulse.sources import changes, topics
from fleetpulse.streaming import bag_stats as bag_stream
from fleetpulse.streaming import bursts as burst_stream
from fleetpulse.streaming import faults as fault_stream
from fleetpulse.streaming import replication as replication_stream
from fleetpulse.streaming import summary as summary_stream
from fleetpulse.streaming import workflow_stats as wf_stream


def flat(df):
    return rows(df, "stat_date", "name", F.array_join("path", "."), F.round("value", 4))


def nonzero(counter):
    return {k: v for k, v in counter.items() if k[-1] is not None}


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return fx.read(spark, sf_dir, "events")


def stream_of(spark, path, schema):
    return topics.messages(topics.file_topic(spark, path, files_per_trigger=1), schema)


def test_workflow_statistics_stream(spark, events, tmp_path):
    raw = fx.workflow_topic(events)
    path = write_topic(raw, str(tmp_path / "in"), 4)
    streamed = wf.reshape(stream_of(spark, path, schemas.WORKFLOW_MESSAGE))
    store = str(tmp_path / "store")
    writer = wf_stream.statistics_stream(streamed, store, str(tmp_path / "cp"))
    run_available(writer)
    batch = wf.statistics(
        wf.reshape(topics.messages(raw, schemas.WORKFLOW_MESSAGE)), drop_late=True)
    assert flat(stats.read_statistics(spark, store)) == flat(batch)

    # a restart from the checkpoint finds nothing new and changes nothing
    run_available(wf_stream.statistics_stream(streamed, store, str(tmp_path / "cp")))
    assert flat(stats.read_statistics(spark, store)) == flat(batch)


def test_workflow_stream_out_of_order_days(spark, events, tmp_path):
    """Records that arrive 20 or 60 hours late: files and seq follow arrival."""
    from pyspark.sql import Window
    late = events.withColumn("arrival", fx.arrival())
    numbered = late.withColumn("arrived", F.row_number().over(
        Window.orderBy("arrival", "event_id")).cast("bigint"))
    raw = fx.workflow_topic(numbered, F.col("arrived")).withColumn("seq", F.col("arrived"))
    path = write_topic(raw.drop("arrived"), str(tmp_path / "in"), 3)
    streamed = wf.reshape(stream_of(spark, path, schemas.WORKFLOW_MESSAGE))
    store = str(tmp_path / "store")
    run_available(wf_stream.statistics_stream(streamed, store, str(tmp_path / "cp")))
    batch_events = wf.reshape(topics.messages(raw.drop("arrived"), schemas.WORKFLOW_MESSAGE))
    kept = open_days(batch_events, ["seq"])
    assert kept.count() < batch_events.count()
    batch = wf.statistics(batch_events, drop_late=True)
    assert flat(stats.read_statistics(spark, store)) == flat(batch)


def test_bag_statistics_stream_and_replay(spark, events, tmp_path):
    raw = fx.bag_topic(events)
    path = write_topic(raw, str(tmp_path / "in"), 3)
    store = str(tmp_path / "store")
    streamed = bag_stats.reshape(stream_of(spark, path, schemas.BAG_MESSAGE))
    run_available(bag_stream.statistics_stream(streamed, store, str(tmp_path / "cp")))
    batch_rows = bag_stats.reshape(topics.messages(raw, schemas.BAG_MESSAGE))
    want = flat(bag_stats.statistics(batch_rows))
    assert flat(stats.read_statistics(spark, store)) == want

    # the same micro-batches once more, as after a lost commit
    run_available(bag_stream.statistics_stream(streamed, store, str(tmp_path / "cp-again")))
    assert flat(stats.read_statistics(spark, store)) == want


def test_fault_stream(spark, events, tmp_path):
    raw = fx.node_topic(events)
    path = write_topic(raw, str(tmp_path / "in"), 5)
    got = fault_stream.alerts(memory(
        fault_stream.fault_events(stream_of(spark, path, schemas.NODE_MESSAGE)),
        "faults", str(tmp_path)))
    want = faults.alerts(faults.fault_sessions(topics.messages(raw, schemas.NODE_MESSAGE)))
    cols = ["cluster_name", "node_name", "fault_type", "level", "seq", "minutes", "info"]
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("clear_after", [False, True])
def test_burst_stream(spark, events, tmp_path, clear_after):
    # dense enough for bursts: all records on two nodes
    dense = events.withColumn("user_id", F.col("user_id") % 2)
    raw = fx.job_topic(dense)
    # one late record closes every window of the others
    last = raw.orderBy(F.col("seq").desc()).limit(1).select(
        (F.col("seq") + 1).alias("seq"), "record_ts",
        F.lit('{"node_name":"zz","job_status":"failed","job_name":"a-b-c-w-replay",'
              '"timestamp":"1704099999000"}').alias("value"))
    closing = raw.unionByName(last)
    path = write_topic(closing, str(tmp_path / "in"), 4)
    failures = bursts.failed_replays(stream_of(spark, path, schemas.JOB_MESSAGE))
    got = memory(burst_stream.burst_events(failures, clear_after=clear_after), "b", str(tmp_path))

    batch_failures = bursts.failed_replays(topics.messages(raw, schemas.JOB_MESSAGE))
    alerts = bursts.burst_alerts(bursts.burst_windows(batch_failures), block=600)
    want = rows(alerts)
    assert sum(want.values()) > 500
    assert rows(burst_stream.alerts(got)) == want
    assert rows(burst_stream.actions(got)) == rows(
        bursts.burst_actions(batch_failures, alerts, clear_after=clear_after))


def test_failure_windows_stream(spark, events, tmp_path):
    raw = fx.pod_topic(events)
    path = write_topic(raw, str(tmp_path / "in"), 4)
    got = memory(summary_stream.failures_per_window(stream_of(spark, path, schemas.POD_MESSAGE)),
                 "w", str(tmp_path))
    batch = summary.failures_per_window(
        summary.with_event_time(topics.messages(raw, schemas.POD_MESSAGE)))
    got, want = rows(got), rows(batch)
    # append mode holds back the windows the watermark has not passed
    missing = want - got
    assert not got - want
    assert {k[0] for k in missing} <= {k[0] for k in want if k[0] >= max(k[0] for k in got)}
    assert got


def test_replication_stream(spark, sf_dir, tmp_path):
    raw = fx.change_log(spark, sf_dir).withColumn("record_ts", F.current_timestamp())
    path = write_topic(raw, str(tmp_path / "in"), 3)
    log = changes.change_rows(
        topics.file_topic(spark, path, files_per_trigger=1), schemas.WORKFLOW_TABLE)
    target = str(tmp_path / "lake")

    def lake_rows(df):
        return rows(replication.to_lake_workflow(df), "workflow_id", "_tag", "upload_ttl")

    want = lake_rows(replication.current_rows(
        changes.change_rows(raw, schemas.WORKFLOW_TABLE), ["workflow_id"]))
    for attempt in ("cp", "cp-again"):
        run_available(replication_stream.replicate(
            log, target, ["workflow_id"], str(tmp_path / attempt)))
        assert lake_rows(tables.current(spark, target)) == want


def test_crash_topic_stream(spark, events, tmp_path):
    from fleetpulse.sinks import topics as topic_sinks
    raw = fx.bag_topic(events)
    path = write_topic(raw, str(tmp_path / "in"), 2)
    kept = summary.crashes(stream_of(spark, path, schemas.BAG_MESSAGE)).drop("seq", "record_ts")
    run_available(topic_sinks.stream_json(kept, str(tmp_path / "cp"), path=str(tmp_path / "out")))
    written = topics.messages(spark.read.text(str(tmp_path / "out")), schemas.BAG_MESSAGE)
    batch = summary.crashes(topics.messages(raw, schemas.BAG_MESSAGE)).drop("seq", "record_ts")
    assert rows(written) == rows(batch)
    assert sum(rows(batch).values()) > 0


def test_rejects_and_rows_are_all_rows(spark, events, tmp_path):
    """Malformed and badly timed messages go to a table; the statistics job goes on without them."""
    from fleetpulse.plans import jobs
    raw = fx.workflow_topic(events.filter("event_id < 60"))
    text = F.col("value")
    odd = raw.withColumn("value", F.when(F.col("seq") % 10 == 1, F.substring(text, 1, 40))
                         .when(F.col("seq") % 10 == 2, F.regexp_replace(
                             text, '"update_time":"[^"]*"', '"update_time":"soon"'))
                         .when(F.col("seq") % 10 == 3, F.regexp_replace(
                             text, '"update_time":"[^"]*",?', '')).otherwise(text))
    topic = jobs.Topic(write_topic(odd, str(tmp_path / "in"), 2))
    store, rejects = str(tmp_path / "store"), str(tmp_path / "rejects")
    run_available(jobs.workflow_statistics(spark, topic, store, str(tmp_path / "cp"),
                                           records=str(tmp_path / "records")))
    run_available(jobs.message_rejects(spark, topic, schemas.WORKFLOW_MESSAGE, rejects,
                                       str(tmp_path / "cp-rejects"), "update_time"))
    reasons = rows(spark.read.parquet(rejects).groupBy("reason").count())
    n = odd.count()
    assert sum(r[1] for r in reasons) == odd.filter("seq % 10 IN (1, 2, 3)").count()
    assert {r[0] for r in reasons} == {"malformed", "bad time", "no time"}
    good = wf.reshape(topics.messages(raw.filter("seq % 10 NOT IN (1, 2, 3)"),
                                      schemas.WORKFLOW_MESSAGE))
    assert good.count() + sum(r[1] for r in reasons) == n
    want = flat(wf.statistics(good, drop_late=True))
    assert flat(stats.read_statistics(spark, store)) == want
    assert spark.read.parquet(str(tmp_path / "records")).count() == len(
        {(k[0], k[1]) for k in want})


def test_uneven_partitions_lose_no_rows(spark, events, tmp_path):
    """An old partition at a high offset comes first, a young one at a low offset after it."""
    old = F.col("event_id") % 2 == 0
    offset = F.when(old, F.col("event_id") + 1_000_000).otherwise(F.col("event_id"))
    raw = fx.workflow_topic(events).withColumn("event_id", F.col("seq")).withColumn(
        "seq", offset * topics.PARTITION_ROOM + F.when(old, 0).otherwise(1)).drop("event_id")
    path = write_topic(raw, str(tmp_path / "in"), 1)
    streamed = wf.reshape(stream_of(spark, path, schemas.WORKFLOW_MESSAGE), ["record_ts"])
    store = str(tmp_path / "store")
    run_available(wf_stream.statistics_stream(streamed, store, str(tmp_path / "cp")))
    batch = wf.reshape(topics.messages(raw, schemas.WORKFLOW_MESSAGE), ["record_ts"])
    kept = open_days(batch, ["record_ts", "seq"])
    assert kept.count() == batch.count() > open_days(batch, ["seq"]).count()
    want = flat(wf.statistics(batch, order=["record_ts", "seq"], drop_late=True))
    assert flat(stats.read_statistics(spark, store)) == want


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Shanghai"])
def test_state_lasts_for_the_local_day(spark, tmp_path, zone):
    """A repeated status on the evening of yesterday counts once, west and east of UTC."""
    message = ('{"workflow_id":"w","workflow_type":"t","workflow_status":"SUCCESS",'
               '"update_time":"%s"}')
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = ["2024-01-01 22:00:00", "2024-01-02 23:30:00", "2024-01-02 23:40:00",
              "2024-01-01 23:00:00"]
        raw = spark.createDataFrame(
            [(i, message % t) for i, t in enumerate(at)],
            "seq bigint, value string").withColumn("record_ts", F.current_timestamp())
        path = write_topic(raw, str(tmp_path / "in"), 4)
        streamed = wf.reshape(stream_of(spark, path, schemas.WORKFLOW_MESSAGE))
        store = str(tmp_path / "store")
        run_available(wf_stream.statistics_stream(streamed, store, str(tmp_path / "cp")))
        batch = wf.statistics(wf.reshape(topics.messages(raw, schemas.WORKFLOW_MESSAGE)))
        assert flat(stats.read_statistics(spark, store)) == flat(batch)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_failures_a_minute_late_count(spark, tmp_path):
    """Four failures on time and a fifth that comes a minute late are a burst."""
    from fleetpulse.plans import jobs
    message = ('{"node_name":"%s","job_status":"failed","job_name":"a-b-c-w%d-replay",'
               '"timestamp":"%d"}')
    base = 1_704_067_200_000
    sent = [("n", i, base + i * 1000) for i in range(4)] + [
        ("z", 9, base + 60_000), ("n", 5, base + 5000), ("z", 9, base + 3_600_000)]
    raw = spark.createDataFrame(
        [(i, message % m) for i, m in enumerate(sent)], "seq bigint, value string").withColumn(
        "record_ts", F.current_timestamp())
    topic = jobs.Topic(write_topic(raw, str(tmp_path / "in"), 7), files_per_trigger=1)
    alerts = str(tmp_path / "alerts")
    run_available(jobs.burst_monitor(spark, topic, alerts, str(tmp_path / "actions"),
                                     str(tmp_path / "cp")))
    got = spark.read.parquet(alerts).filter("outcome = 'alert'").collect()
    assert [(r.node_name, r.n, r.level) for r in got] == [("n", 5, "burst")]
    assert got[0].info.startswith("node n: 5 failed replays from 2024-01-01 00:00:00")
