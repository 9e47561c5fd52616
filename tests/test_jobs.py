"""Jobs end to end on folders: file topics in, tables out."""

import json
import time
from datetime import date, datetime, timedelta

import pytest
from helpers import rows, run_available, write_topic
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.operators import faults, replication, summary, transfer
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.plans import fixtures as fx
from fleetpulse.plans import jobs
from fleetpulse.sinks import stats, tables
from fleetpulse.sources import topics
from fleetpulse.sources.lake import lake_table


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return fx.read(spark, sf_dir, "events")


def topic(raw, folder, parts=2):
    return jobs.Topic(write_topic(raw, str(folder), parts), files_per_trigger=1)


def test_statistics_jobs(spark, events, tmp_path):
    source = topic(fx.workflow_topic(events), tmp_path / "wf")
    run_available(jobs.workflow_statistics(
        spark, source, str(tmp_path / "s1"), str(tmp_path / "c1"), as_of=date(2024, 1, 20)))
    got = stats.read_statistics(spark, str(tmp_path / "s1"))
    assert got.agg(F.min("stat_date")).first()[0] == date(2024, 1, 19)
    want = wf.statistics(
        wf.reshape(topics.messages(fx.workflow_topic(events), schemas.WORKFLOW_MESSAGE)),
        as_of=date(2024, 1, 20), drop_late=True)
    key = ["stat_date", "name", F.array_join("path", "."), F.round("value", 4)]
    assert rows(got, *key) == rows(want, *key)

    bags = topic(fx.bag_topic(events), tmp_path / "bag")
    run_available(jobs.bag_statistics(spark, bags, str(tmp_path / "s2"), str(tmp_path / "c2")))
    assert stats.read_statistics(spark, str(tmp_path / "s2")).count() > 0


def test_monitor_jobs(spark, events, tmp_path):
    nodes = topic(fx.node_topic(events), tmp_path / "node")
    run_available(jobs.node_monitor(spark, nodes, str(tmp_path / "al"), str(tmp_path / "c1")))
    run_available(jobs.node_rejects(spark, nodes, str(tmp_path / "rej"), str(tmp_path / "c2")))
    messages = topics.messages(fx.node_topic(events), schemas.NODE_MESSAGE)
    known, unknown = faults.route(messages)
    want = faults.alerts(faults.fault_sessions(messages))
    assert rows(lake_table(spark, str(tmp_path / "al")), "info") == rows(want, "info")
    assert lake_table(spark, str(tmp_path / "rej")).count() == unknown.count()
    assert known.count() + unknown.count() == messages.count()

    dense = events.withColumn("user_id", F.lit(1))
    work = topic(fx.job_topic(dense), tmp_path / "job")
    run_available(jobs.burst_monitor(
        spark, work, str(tmp_path / "ba"), str(tmp_path / "bx"), str(tmp_path / "c3")))
    assert lake_table(spark, str(tmp_path / "ba")).filter("outcome = 'alert'").count() > 1
    done = lake_table(spark, str(tmp_path / "bx"))
    assert {(r.kind, r.priority) for r in done.collect()} == {
        ("cordon", None), ("raise_priority", 3)}


def test_burst_monitor_by_processing_time(spark, tmp_path):
    """Twenty failures at once and nothing after: the window is judged when the clock passes it."""
    made = [(i, datetime(2024, 1, 1), json.dumps({
        "node_name": "n1" if i < 20 else "n2", "job_status": "failed",
        "job_name": f"a-b-c-wf{i % 3}-replay", "timestamp": "1704067200000"})) for i in range(24)]
    raw = spark.createDataFrame(made, "seq long, record_ts timestamp, value string")
    work = topic(raw, tmp_path / "job", 1)
    alerts = str(tmp_path / "a")
    query = jobs.start(jobs.burst_monitor(
        spark, work, alerts, str(tmp_path / "x"), str(tmp_path / "c"), processing_time=True),
        "1 second")
    try:
        until = time.time() + 120
        while time.time() < until and not list((tmp_path / "x").glob("batch_id=*/*.parquet")):
            time.sleep(1)
        assert query.exception() is None
    finally:
        query.stop()
    told = lake_table(spark, alerts).filter("outcome = 'alert'").collect()
    assert [(r.node_name, r.n) for r in told] == [("n1", 20)]
    done = lake_table(spark, str(tmp_path / "x"))
    assert rows(done.filter("kind = 'raise_priority'"), F.explode("targets")) == {
        (f"wf{k}",): 1 for k in range(3)}
    assert done.filter("kind = 'cordon'").count() == 1


@pytest.mark.parametrize("kind,schema,good", [
    ("job", schemas.JOB_MESSAGE, ["1704067200000", "1704067201000"]),
    ("node", schemas.NODE_MESSAGE, [1704067200.5, 1704067201]),
    ("pod", schemas.POD_MESSAGE, [1704067200.5, 0])])
def test_rejects_of_numeric_times(spark, tmp_path, kind, schema, good):
    field, read_time = jobs.MESSAGE_TIMES[kind]
    values = [*good, "soon", None, 1e300 if kind != "job" else "99x"]
    made = [(i, datetime(2024, 1, 1), json.dumps({field: v})) for i, v in enumerate(values)]
    made.append((5, datetime(2024, 1, 1), "broken"))
    raw = spark.createDataFrame(made, "seq long, record_ts timestamp, value string")
    source = topic(raw, tmp_path / "in", 1)
    run_available(jobs.message_rejects(spark, source, schema, str(tmp_path / "r"),
                                       str(tmp_path / "c"), field, read_time))
    told = {r.seq: r.reason for r in lake_table(spark, str(tmp_path / "r")).collect()}
    soon = "bad time" if kind == "job" else "malformed"
    assert told == {2: soon, 3: "no time", 4: "bad time", 5: "malformed"}
    used = topics.messages(raw, schema).filter(read_time(F.col(field)).isNotNull())
    assert used.count() + len(told) == raw.count()


def test_pod_and_crash_jobs(spark, events, tmp_path):
    pods = topic(fx.pod_topic(events), tmp_path / "pod")
    run_available(jobs.pod_failures(spark, pods, str(tmp_path / "f"), str(tmp_path / "c1")))
    run_available(jobs.pod_log_tags(spark, pods, str(tmp_path / "t"), str(tmp_path / "c2")))
    assert lake_table(spark, str(tmp_path / "f")).count() > 0
    assert lake_table(spark, str(tmp_path / "t")).count() == events.count()
    bags = topic(fx.bag_topic(events), tmp_path / "bag")
    run_available(jobs.crash_topic(spark, bags, str(tmp_path / "c3"), path=str(tmp_path / "out")))
    crashed = summary.crashes(topics.messages(fx.bag_topic(events), schemas.BAG_MESSAGE))
    assert spark.read.text(str(tmp_path / "out")).count() == crashed.count()


def test_replication_jobs(spark, sf_dir, tmp_path):
    log = fx.change_log(spark, sf_dir).withColumn("record_ts", F.current_timestamp())
    run_available(jobs.replicate_workflows(
        spark, topic(log, tmp_path / "in"), str(tmp_path / "lake"), str(tmp_path / "cp")))
    got = tables.current(spark, str(tmp_path / "lake"))
    assert "_tag" in got.columns
    assert got.count() == fx.workflow_table(spark, sf_dir).count()

    image = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name != "id"
                       else F.lit("r1").alias("id") for f in schemas.RESULT_TABLE.fields])
    one = spark.range(2).select(
        F.col("id").alias("seq"), F.current_timestamp().alias("record_ts"),
        F.to_json(F.struct(F.lit("c").alias("op"), F.col("id").alias("seq"),
                           image.alias("after"))).alias("value"))
    run_available(jobs.replicate_results(
        spark, topic(one, tmp_path / "in2", 1), str(tmp_path / "lake2"), str(tmp_path / "cp2")))
    assert [(r.id, r.seq) for r in tables.current(
        spark, str(tmp_path / "lake2")).collect()] == [("r1", 1)]


def test_replicated_folders_are_tables(spark, tmp_path):
    """Replicate out of order and again after a delete, then retention and counts on the folders."""
    def change(op, seq, key, day, table_schema, name):
        given = {name: F.lit(key), "create_time": F.lit(day).cast("timestamp_ntz")}
        if name == "id":
            given["workflow_id_id"] = F.lit(key[1:])
        image = F.struct(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in table_schema.fields])
        side = "before" if op == "d" else "after"
        return spark.range(1).select(
            F.lit(seq).cast("bigint").alias("seq"), F.current_timestamp().alias("record_ts"),
            F.to_json(F.struct(F.lit(op).alias("op"), F.lit(seq).alias("seq"),
                               image.alias(side))).alias("value"))

    def run(job, rows_in, table_schema, name, target):
        log = None
        for row in rows_in:
            one = change(*row, table_schema, name)
            log = one if log is None else log.unionByName(one)
        run_available(job(spark, topic(log, tmp_path / f"in-{name}", 2), target, f"{target}-cp"))

    parents, kids = str(tmp_path / "parents"), str(tmp_path / "kids")
    run(jobs.replicate_workflows,
        [("u", 9, "a", "2024-01-02"), ("c", 1, "a", "2024-01-01"), ("c", 2, "b", "2024-01-01"),
         ("d", 3, "b", "2024-01-01"), ("c", 4, "b", "2024-01-05"), ("c", 5, "c", "2024-01-01")],
        schemas.WORKFLOW_TABLE, "workflow_id", parents)
    run(jobs.replicate_results,
        [("c", 1, "ra", "2024-01-02"), ("c", 2, "rc", "2024-01-01"), ("c", 3, "rb", "2024-01-05")],
        schemas.RESULT_TABLE, "id", kids)
    as_of = date(2024, 1, 1) + timedelta(days=91)
    jobs.retention(spark, parents, kids, as_of, str(tmp_path / "staging"))
    assert rows(lake_table(spark, parents), "workflow_id", "seq") == {("a", 9): 1, ("b", 4): 1}
    assert rows(lake_table(spark, kids), "id") == {("ra",): 1, ("rb",): 1}
    counts = jobs.check_counts(
        tables.current(spark, parents), tables.current(spark, kids), "create_time", "create_time")
    assert counts.count() == 2 and counts.filter("NOT match").count() == 0


def test_decoded_table(spark, events, tmp_path):
    raw = fx.job_topic(events).unionByName(spark.createDataFrame(
        [(10**6, datetime(2024, 1, 3), "broken")], "seq bigint, record_ts timestamp, value string"))
    source = topic(raw, tmp_path / "in")
    for _ in range(2):
        jobs.decoded_table(spark, source, schemas.JOB_MESSAGE, str(tmp_path / "t"),
                           str(tmp_path / "r"))
    assert lake_table(spark, str(tmp_path / "t")).count() == events.count()
    assert [r._corrupt_record for r in lake_table(spark, str(tmp_path / "r")).collect()] == [
        "broken"]


def test_daily_copy_and_retention(spark, sf_dir, tmp_path):
    parents, children = fx.workflow_table(spark, sf_dir), fx.result_table(spark, sf_dir)
    wf_target, res_target = str(tmp_path / "wf"), str(tmp_path / "res")
    busiest = parents.groupBy(F.to_date("create_time").alias("d")).count().orderBy(
        F.desc("count"), "d").first()["d"]
    first = busiest - timedelta(days=5)
    for n in [*range(11), 3]:
        jobs.daily_copy(parents, children, wf_target, res_target, first + timedelta(days=n + 31))
    begin = datetime.combine(first, datetime.min.time())
    bounds = transfer.in_range(F.col("create_time"), begin, begin + timedelta(days=11))
    copied = replication.to_lake_workflow(parents.filter(bounds))
    assert rows(lake_table(spark, wf_target), *copied.columns) == rows(copied)
    kids = transfer.children_in(children, copied, "workflow_id_id", "workflow_id")
    assert rows(lake_table(spark, res_target), *kids.columns) == rows(kids)
    assert sum(rows(kids).values()) > 0

    # the busiest day leaves the retention period; a repeated run changes nothing
    for _ in range(2):
        jobs.retention(spark, wf_target, res_target, busiest + timedelta(days=91),
                       str(tmp_path / "st"), 90)
        left = copied.filter(F.to_date("create_time") != F.lit(busiest))
        assert 0 < left.count() < copied.count()
        assert rows(lake_table(spark, wf_target), *copied.columns) == rows(left)
        kept = transfer.children_in(children, left, "workflow_id_id", "workflow_id")
        assert rows(lake_table(spark, res_target), *kids.columns) == rows(kept)


class FolderBackfill:
    """Stands in for the JDBC source: same calls, a Parquet folder behind them."""

    plan_time, page, not_null = "create_time", "pmod(hash(workflow_id), {pages})", ("workflow_id",)

    def __init__(self, table):
        self.table, self.predicates = table, []

    def histogram(self, spark, start, end):
        chosen = transfer.in_range(F.col("create_time"), start, end)
        return transfer.histogram(self.table.filter(chosen), "create_time")

    def read(self, spark, predicates):
        self.predicates = predicates
        parts = [self.table.filter(p) for p in predicates]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def test_backfill(spark, sf_dir, tmp_path):
    table = fx.workflow_table(spark, sf_dir)
    source = FolderBackfill(table)
    target, log = str(tmp_path / "t"), str(tmp_path / "log")
    start, end = date(1997, 1, 1), date(1997, 1, 15)
    for _ in range(2):
        runs = jobs.backfill(
            spark, source, start, end, target, log, rows=2, shape=replication.to_lake_workflow)
    want = table.filter(transfer.in_range(
        F.col("create_time"), datetime(1997, 1, 1), datetime(1997, 1, 15)))
    assert any("pmod" in p for p in source.predicates) or want.count() < 20
    assert rows(lake_table(spark, target), "workflow_id") == rows(want, "workflow_id")
    assert runs.filter(~F.col("match")).count() == 0
    assert runs.agg(F.sum("n_left")).first()[0] == want.count()
    with pytest.raises(RuntimeError, match="days differ"):
        jobs.log_days(spark, source.histogram(spark, datetime(1996, 1, 1), datetime(1996, 2, 1)),
                      target, log, date(1996, 1, 1), date(1996, 2, 1))


def test_copies_out_of_a_database(spark, sf_dir, tmp_path, monkeypatch):
    """The queries and options of whole and daily copies, with tables standing in for the database."""
    workflows, results = fx.workflow_table(spark, sf_dir), fx.result_table(spark, sf_dir)
    asked = []

    def table(spark, options, query):
        asked.append(query)
        assert options["url"] == "jdbc:x" and options["user"] == "u"
        rows_in = results if "results" in query else workflows
        if "COUNT(*)" in query:
            return rows_in.agg(F.count("*").alias("n"))
        if "MIN(" in query:
            return rows_in.agg(F.min("create_time").alias("lower"), F.max("create_time").alias("upper"))
        first, last = transfer.day_bounds(date(1997, 3, 5), 31)
        chosen = workflows.filter(transfer.in_range(F.col("create_time"), first, last))
        return chosen if "results" not in query else transfer.children_in(
            results, chosen, "workflow_id_id", "workflow_id")

    split = {}

    def split_table(spark, options, query, column, lower, upper, parts):
        split.update(query=query, column=column, lower=lower, upper=upper, parts=parts)
        return results

    monkeypatch.setattr(jobs.jdbc, "table", table)
    monkeypatch.setattr(jobs.jdbc, "split_table", split_table)
    source = jobs.Source("jdbc:x", {"user": "u"}, "results r", "r.*", "r.create_time", 1_000)
    counts = jobs.full_copy_from(spark, source, str(tmp_path / "full")).collect()
    n = results.count()
    assert [tuple(r) for r in counts] == [(n, n, True)]
    assert split["column"] == "create_time" and split["parts"] == -(-n // 1_000)
    assert split["query"] == "(SELECT r.* FROM results r) t" and split["lower"] < split["upper"]

    parents = jobs.Source("jdbc:x", {"user": "u"}, "workflows", "*", "create_time")
    joined = jobs.Source("jdbc:x", {"user": "u"}, "results r JOIN workflows w ON r.w = w.id", "r.*",
                         "w.create_time")
    asked.clear()
    jobs.daily_copy_from(spark, parents, joined, str(tmp_path / "wf"), str(tmp_path / "res"),
                         date(1997, 3, 5), 31)
    first, last = transfer.day_bounds(date(1997, 3, 5), 31)
    assert all(f"create_time >= '{first:%Y-%m-%d}" in q and f"< '{last:%Y-%m-%d}" in q for q in asked)
    chosen = workflows.filter(transfer.in_range(F.col("create_time"), first, last))
    assert chosen.count() == lake_table(spark, str(tmp_path / "wf")).count() > 0
    kids = transfer.children_in(results, chosen, "workflow_id_id", "workflow_id")
    assert lake_table(spark, str(tmp_path / "res")).count() == kids.count()


def test_backfill_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    table = fx.workflow_table(spark, sf_dir)
    start, end = date(1997, 1, 1), date(1997, 1, 11)
    inside = transfer.in_range(F.col("create_time"), datetime(1997, 1, 1), datetime(1997, 1, 11))
    days = sorted({r[0] for r in table.filter(inside).select(F.to_date("create_time")).collect()})

    class Stopping(FolderBackfill):
        left = 2

        def read(self, spark, predicates):
            if self.left == 0:
                raise InterruptedError
            self.left -= 1
            self.days = [*getattr(self, "days", []), predicates[0]]
            return super().read(spark, predicates)

    target, log = str(tmp_path / "t"), str(tmp_path / "log")
    args = (start, end, target, log)
    with pytest.raises(InterruptedError):
        jobs.backfill(spark, Stopping(table), *args, shape=replication.to_lake_workflow)
    second = Stopping(table)
    second.left = 99
    jobs.backfill(spark, second, *args, shape=replication.to_lake_workflow)
    assert len(second.days) == len(days) - 2  # the finished days are not read again
    want = rows(table.filter(inside), "workflow_id")
    assert rows(lake_table(spark, target), "workflow_id") == want
    # after a verified run all days are copied again; a day that the source lost is emptied
    fewer = Stopping(table.filter(F.to_date("create_time") != F.lit(days[0])))
    fewer.left = 99
    for _ in range(2):
        jobs.backfill(spark, fewer, *args, shape=replication.to_lake_workflow)
    assert len(fewer.days) == 2 * (len(days) - 1)
    assert lake_table(spark, target).filter(F.col("day") == F.lit(days[0])).count() == 0
    assert lake_table(spark, target).count() == fewer.table.filter(inside).count()


def test_full_copy_and_checks(spark, sf_dir, tmp_path):
    children = fx.result_table(spark, sf_dir)
    jobs.full_copy(children, str(tmp_path / "full"))
    copy = lake_table(spark, str(tmp_path / "full"))
    assert copy.count() == children.count()
    assert len(copy.first()["create_time"]) == 26
    source = fx.workflow_table(spark, sf_dir)
    lake = replication.to_lake_workflow(source)
    assert jobs.check_workflows(source, lake).count() == 0
    assert jobs.check_counts(source, lake, "create_time", "create_time").filter(
        "NOT match").count() == 0
    single = children.dropDuplicates(["id"])
    changed = single.withColumn("log", F.lit("other"))
    assert jobs.check_results(single, changed).select("column").distinct().collect()[0][0] == "log"
