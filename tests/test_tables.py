"""Writers, transfer, reconciliation and source options."""

from datetime import date, datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.operators import reconcile, replication, transfer
from fleetpulse.plans import fixtures as fx
from fleetpulse.session import catalog_conf, checkpoint_root, session_conf
from fleetpulse.sinks import stats, tables
from fleetpulse.sources import jdbc, lake, topics


def table(spark, data):
    return spark.createDataFrame(data, "id int, day string, v string")


def test_overwrite_parts_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.overwrite_parts(table(spark, [(1, "a", "x"), (2, "b", "y")]), target, ["day"])
    for _ in range(2):
        tables.overwrite_parts(table(spark, [(3, "b", "z")]), target, ["day"])
    assert rows(lake.lake_table(spark, target), "id", "day", "v") == {
        (1, "a", "x"): 1, (3, "b", "z"): 1}
    tables.append(table(spark, [(4, "c", "w")]).select("id", "v"), str(tmp_path / "plain"))
    assert lake.lake_table(spark, str(tmp_path / "plain")).count() == 1


def test_overwrite_days(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, 5))], "id int, at timestamp_ntz")
    for _ in range(2):
        tables.overwrite_days(df, target, "at")
    assert lake.lake_table(spark, target).count() == 1


def test_delete_keys(spark, tmp_path):
    target = str(tmp_path / "t")
    data = [(i, "abc"[i % 3], "v") for i in range(30)]
    tables.overwrite_parts(table(spark, data), target, ["day"])
    gone = table(spark, [(i, "", "") for i in range(30) if i % 3 == 0 or i == 4])
    tables.delete_keys(spark, target, gone, "id", ["day"], str(tmp_path / "staging"))
    left = rows(lake.lake_table(spark, target), "id", "day")
    assert left == {(i, "abc"[i % 3]): 1 for i in range(30) if i % 3 and i != 4}


def test_upsert_replays_and_order(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "id int, seq bigint, v string"
    batches = [[(1, 1, "a"), (2, 2, "b"), (1, 3, "c")], [(1, 5, "e"), (3, 6, "f")], [(2, 1, "old")]]
    for n in (0, 1, 1, 2, 0):
        tables.upsert(spark.createDataFrame(batches[n], schema), target, ["id"], "seq")
        assert tables.current(spark, target).groupBy("id").count().filter("count > 1").isEmpty()
    assert rows(tables.current(spark, target), "id", "seq", "v") == {
        (1, 5, "e"): 1, (2, 2, "b"): 1, (3, 6, "f"): 1}


def test_merge_sql():
    sql = tables.merge_sql("c.d.t", "v", ["id", "seq", "user"], ["id"], "seq")
    assert sql == (
        "MERGE INTO c.d.t t USING v s ON t.`id` = s.`id` WHEN MATCHED AND (t.`seq` IS NULL OR "
        "s.`seq` > t.`seq`) THEN UPDATE SET t.`seq` = s.`seq`, t.`user` = s.`user` "
        "WHEN NOT MATCHED THEN INSERT (`id`, `seq`, `user`) VALUES (s.`id`, s.`seq`, s.`user`)")


def test_statistics_store(spark, tmp_path):
    store = str(tmp_path / "s")
    assert stats.newest_day(spark, store, 0) is None
    schema = "stat_date date, name string, path array<string>, value double"
    day = date(2024, 1, 1)
    for batch in (0, 1, 1):
        delta = spark.createDataFrame([(day, "n", ["p"], 1.0), (day, "n", ["p"], 2.0)], schema)
        stats.write_deltas(delta, store, batch)
        at = datetime(2024, 1, 1 + batch)
        stats.write_progress(spark, store, batch, day + timedelta(days=batch), at, at)
    assert [r.value for r in stats.read_statistics(spark, store).collect()] == [6.0]
    assert stats.newest_day(spark, store, 1) == day
    assert stats.newest_day(spark, store, 2) == day + timedelta(days=1)
    stats.compact(spark, store, f"{store}-fresh")
    assert [r.value for r in stats.read_statistics(spark, f"{store}-fresh").collect()] == [6.0]
    assert stats.newest_day(spark, f"{store}-fresh", 0) == day + timedelta(days=1)
    for _ in range(2):
        stats.upsert_records(stats.read_statistics(spark, store), f"{store}/records")
    assert lake.lake_table(spark, f"{store}/records").count() == 1


def test_latest_images_and_snapshot(spark):
    image = "struct<workflow_id:string,tag:string,upload_ttl:double>"
    changes = spark.createDataFrame([
        ("c", 1, None, ("a", "t1", 1.5)), ("ub", 2, ("a", "t1", 1.5), None),
        ("u", 3, None, ("a", "t2", 2.5)), ("d", 4, ("a", "t2", 2.5), None),
        ("d", 5, ("b", "t", 0.0), None),
    ], f"op string, seq bigint, before {image}, after {image}")
    got = replication.to_lake_workflow(replication.current_rows(changes, ["workflow_id"]))
    assert got.columns == ["workflow_id", "_tag", "upload_ttl"]
    assert rows(got) == {("a", "t2", 3): 1}
    snapshot = spark.createDataFrame(
        [("a", "old", 0.0), ("z", "old", -0.5)],
        "workflow_id string, tag string, upload_ttl double")
    both = replication.current_rows(replication.with_snapshot(snapshot, changes), ["workflow_id"])
    assert rows(replication.to_lake_workflow(both)) == {("a", "t2", 3): 1, ("z", "old", -1): 1}


@pytest.mark.parametrize("limit", [1, 7, 50, 5000])
@pytest.mark.parametrize("slice", ["hour", "day"])
def test_range_plan_invariants(spark, sf_dir, limit, slice):
    # hot seconds on purpose: a third of all rows lies in one of them
    ts = F.date_trunc("minute", "ts")
    events = fx.read(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit(datetime(2024, 1, 9)).cast(
            "timestamp_ntz")).otherwise(ts.cast("timestamp_ntz")).alias("at"))
    per_second = transfer.histogram(events, "at")
    plan = transfer.range_plan(per_second, limit, slice)
    ranges = sorted((r.range_start, r.range_end, r.n, r.pages) for r in plan.collect())
    counts = {r.second: r.n for r in per_second.collect()}
    assert sum(n for _, _, n, _ in ranges) == events.count()
    for (_, end, _, _), (start, _, _, _) in zip(ranges, ranges[1:]):
        assert end <= start
    for start, end, n, pages in ranges:
        assert n <= limit or end - start == timedelta(seconds=1)
        assert pages == -(-n // limit)
        assert n == sum(c for s, c in counts.items() if start <= s < end)
    untimed = events.limit(1).withColumn("at", F.lit(None).cast("timestamp_ntz"))
    placed = transfer.assign_ranges(
        events.unionByName(untimed), transfer.labelled_seconds(per_second, limit, slice), "at",
        ["event_id"])
    assert placed.filter("range_start IS NULL AND page IS NULL").count() == 1
    placed = placed.filter("at IS NOT NULL")
    assert rows(placed.groupBy("range_start").count()) == {(r[0], r[2]): 1 for r in ranges}
    pages = placed.groupBy("range_start").agg(F.min("page"), F.max("page")).collect()
    limits = {r[0]: r[3] for r in ranges}
    assert all(0 <= lo <= hi < limits[start] for start, lo, hi in pages)


def test_incremental_and_retention(spark):
    parents = spark.createDataFrame(
        [(str(i), datetime(2024, 1, 1) + timedelta(hours=12 * i)) for i in range(10)],
        "workflow_id string, create_time timestamp_ntz")
    children = spark.createDataFrame(
        [(f"r{i}", str(i // 2)) for i in range(20)], "id string, workflow_id_id string")
    chosen, kids = transfer.incremental(parents, children, date(2024, 1, 5), lag_days=2)
    assert sorted(r[0] for r in chosen.collect()) == ["2", "3"]
    assert sorted(r.id for r in kids.collect()) == ["r4", "r5", "r6", "r7"]
    start, end = transfer.retention_bounds(date(2024, 3, 31))
    assert (start, end) == (datetime(2023, 12, 31), datetime(2024, 1, 1))
    left, kept = transfer.retained(parents, children, datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert sorted(r[0] for r in left.collect()) == ["0", "1", "4", "5", "6", "7", "8", "9"]
    assert kept.count() == 16


def test_require_not_null(spark):
    schema = "k string, at timestamp_ntz, v int"
    row = ("a", datetime(2024, 1, 1), 1)
    strict = transfer.require_not_null(spark.createDataFrame([row], schema), ["k", "at"])
    assert [f.nullable for f in strict.schema.fields] == [False, False, True]
    assert rows(strict) == {row: 1}
    bad = spark.createDataFrame([(None, None, 1)], schema)
    for c in ("k", "at"):
        with pytest.raises(Exception, match=f"null in {c}"):
            transfer.require_not_null(bad, [c]).collect()


@pytest.mark.parametrize("kind,value", [
    ("array<int>", [1]), ("map<string,array<int>>", {"a": [1]}), ("date", date(2024, 1, 1)),
    ("struct<a:int,b:array<string>>", (1, ["x"])), ("binary", bytearray(b"x")),
    ("boolean", True), ("decimal(9,2)", None), ("double", 1.5),
    ("array<struct<a:int not null,b:map<string,int>>>", [(1, {"k": 2})])])
def test_require_not_null_of_any_type(spark, kind, value):
    df = spark.createDataFrame([(value,)] if value is not None else [], f"v {kind}")
    strict = transfer.require_not_null(df, ["v"])
    assert not strict.schema["v"].nullable
    assert strict.collect() == df.collect()
    with pytest.raises(Exception, match="null in v"):
        transfer.require_not_null(spark.createDataFrame([(None,)], f"v {kind}"), ["v"]).collect()


def test_page_is_ordered(spark, sf_dir):
    orders = fx.read(spark, sf_dir, "orders")
    got = [r.o_orderkey for r in transfer.page(
        orders.select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 5, 3).collect()]
    every = [r.o_orderkey for r in orders.orderBy("o_orderdate", "o_orderkey").collect()]
    assert got == every[3:8]


def test_compare_fields(spark):
    schema = "k string, a int, tag string"
    left = spark.createDataFrame([("1", 1, "x"), ("2", 2, None), ("3", 3, "z")], schema)
    right = spark.createDataFrame([("1", 1, "x"), ("2", 2, "y"), ("4", 4, "w")],
                                  "k string, a int, _tag string")
    got = reconcile.compare_fields(left, right, "k", ["a", "tag"], {"tag": "_tag"})
    assert rows(got) == {
        ("2", "tag", None, "y"): 1, ("3", "<missing right>", "3", None): 1,
        ("4", "<missing left>", None, "4"): 1}


def test_compare_totals_and_order(spark):
    info = "name string, period string, stat_date string, info string"
    left = spark.createDataFrame([
        ("s", "daily", "2024-01-01 00:00:00", '{"a":2,"b":1.5,"t":"x"}'),
        ("s", "daily", "2024-01-02 00:00:00", '{"a":2}'),
        ("s", "daily", "2024-01-03 00:00:00", '{"a":100}'),
        ("s", "hourly", "2024-01-01 00:00:00", '{"a":100}'),
        ("stat_replay_error_bag_count_group_by_category", "daily", "2024-01-01", '{"a":{"b":1}}'),
        ("stat_replay_time_consuming_group_by_category", "daily", "2024-01-01 00:00:00",
         '{"dev":{"cat":{"total":{"total":7.9,"x":1}},"none":{"total":{}}}}'),
    ], info)
    right = spark.createDataFrame([
        ("s", "daily", "2024-01-01 00:00:00", '{"a":8,"c":4}'),
        ("REALTIME_s", "daily", "2024-01-01 00:00:00", '{"a":8}'),
    ], info)
    window = ("2024-01-01", "2024-01-03")
    out = reconcile.worst_last(reconcile.compare_totals(
        reconcile.totals(reconcile.daily_records(left, *window)),
        reconcile.totals(reconcile.daily_records(right, *window, skip_live=True))))
    assert [tuple(r) for r in out.collect()] == [
        ("s", "c", 0, 4, -4, -100.0), ("s", "a", 4, 8, -4, -50.0),
        ("dev", "cat", 7, 0, 7, None), ("s", "b", 1, 0, 1, None)]


def test_jdbc_text():
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 2)
    assert jdbc.range_query("t2.*", "w t1 JOIN r t2 ON t2.w = t1.id", "t1.at", a, b) == (
        "(SELECT t2.* FROM w t1 JOIN r t2 ON t2.w = t1.id WHERE t1.at >= '2024-01-01 00:00:00' "
        "AND t1.at < '2024-01-01 00:00:02') t")
    plan = [{"range_start": a, "range_end": b, "pages": 1},
            {"range_start": b, "range_end": b + timedelta(seconds=1), "pages": 2}]
    got = jdbc.range_predicates(plan, "at", "MOD(CRC32(id), {pages})")
    assert got == [
        "at >= '2024-01-01 00:00:00' AND at < '2024-01-01 00:00:02'",
        "at >= '2024-01-01 00:00:02' AND at < '2024-01-01 00:00:03' AND MOD(CRC32(id), 2) = 0",
        "at >= '2024-01-01 00:00:02' AND at < '2024-01-01 00:00:03' AND MOD(CRC32(id), 2) = 1"]
    opts = jdbc.jdbc_options("jdbc:x", {"user": "u"}, schemas.layout("id string, n integer"),
                             "SET time_zone = '+00:00'")
    assert opts["customSchema"] == "`id` string, `n` int"
    assert opts["sessionInitStatement"].startswith("SET")
    assert "GROUP BY s" in jdbc.histogram_query("w", "at", "s")


def test_source_options():
    assert topics.start_options(datetime.fromtimestamp(1_700_000_000))["startingTimestamp"] == (
        "1700000000000")
    assert topics.start_options("earliest") == {"startingOffsets": "earliest"}
    assert topics.start_options(group_prefix="g") == {
        "startingOffsets": "latest", "groupIdPrefix": "g"}


def test_file_topic_start(spark, sf_dir, tmp_path):
    raw = fx.node_topic(fx.read(spark, sf_dir, "events"))
    raw.write.json(str(tmp_path / "in"))
    start = datetime(2024, 1, 10)
    got = topics.file_topic(spark, str(tmp_path / "in"), start, stream=False)
    assert 0 < got.count() == raw.filter(F.col("record_ts") >= F.lit(start)).count() < raw.count()


def test_session_settings(spark, tmp_path):
    conf = session_conf("Asia/Shanghai", {"a": "b"})
    assert conf["spark.sql.session.timeZone"] == "Asia/Shanghai" and conf["a"] == "b"
    assert catalog_conf("lake", {"class": "x.Catalog", "type": "hive", "uri": "u"}) == {
        "spark.sql.catalog.lake": "x.Catalog", "spark.sql.catalog.lake.type": "hive",
        "spark.sql.catalog.lake.uri": "u"}
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert checkpoint_root(spark, str(tmp_path)) == (shared or str(tmp_path))
    if not shared:
        with pytest.raises(ValueError):
            checkpoint_root(spark)


def test_delete_keys_again_with_the_same_staging(spark, tmp_path):
    """Rows that came between two runs stay, deleted ones don't come back, an emptied day goes."""
    target, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    tables.overwrite_parts(table(spark, [(1, "a", "x"), (2, "a", "x"), (3, "b", "x")]), target,
                           ["day"])
    tables.delete_keys(spark, target, table(spark, [(1, "", "")]), "id", ["day"], staging)
    tables.overwrite_parts(table(spark, [(2, "a", "x"), (9, "a", "new")]), target, ["day"])
    tables.delete_keys(spark, target, table(spark, [(3, "", "")]), "id", ["day"], staging)
    assert rows(lake.lake_table(spark, target), "id", "day") == {(2, "a"): 1, (9, "a"): 1}
    tables.delete_keys(
        spark, target, table(spark, [(2, "", ""), (9, "", "")]), "id", ["day"], staging)
    assert spark.read.schema("id int, v string, day string").parquet(target).count() == 0


def test_emptied_day_is_replaced(spark, tmp_path):
    target = str(tmp_path / "t")
    days = [(1, datetime(2024, 1, 1, 5)), (2, datetime(2024, 1, 2, 5))]
    tables.overwrite_days(spark.createDataFrame(days, "id int, at timestamp_ntz"), target, "at")
    fresh = spark.createDataFrame(days[:1], "id int, at timestamp_ntz")
    tables.overwrite_days(fresh, target, "at", days=[date(2024, 1, 1), date(2024, 1, 2)])
    assert rows(lake.lake_table(spark, target), "id") == {(1,): 1}


def deltas(spark, name, *values, day="2024-01-01"):
    return spark.createDataFrame([(name, ["k"], float(v)) for v in values],
                                 "name string, path array<string>, value double").withColumn(
        "stat_date", F.lit(day).cast("date"))


def test_statistics_of_one_day_share_a_table(spark, tmp_path):
    target = str(tmp_path / "records")
    for name, value in (("wf_metric", 1), ("bag_metric", 2), ("wf_metric", 3)):
        stats.upsert_records(deltas(spark, name, value), target)
    assert rows(spark.read.parquet(target), "name", "info") == {
        ("wf_metric", '{"k":3}'): 1, ("bag_metric", '{"k":2}'): 1}


def test_replay_with_a_new_checkpoint_counts_once(spark, tmp_path):
    store = str(tmp_path / "store")
    first = stats.run_of(spark, store, "cp-1")
    for batch in range(3):
        stats.write_deltas(deltas(spark, "m", 1), store, batch, first)
        stats.write_deltas(deltas(spark, "m", 7, day="2023-12-31"), store, 10 + batch, first)
        stats.write_progress(spark, store, batch, date(2024, 1, 1), datetime(2023, 12, 31),
                             datetime(2024, 1, 1), first)
    again = stats.run_of(spark, store, "cp-2")
    assert stats.run_of(spark, store, "cp-1") == first != again
    assert stats.newest_day(spark, store, 99, again) is None
    stats.write_deltas(deltas(spark, "m", 3), store, 0, again)
    at = datetime(2024, 1, 1)
    stats.write_progress(spark, store, 0, date(2024, 1, 1), at, at, again)

    def sums(folder):
        return rows(stats.read_statistics(spark, folder).select(
            F.col("stat_date").cast("string"), "value"))

    want = {("2024-01-01", 3.0): 1, ("2023-12-31", 21.0): 1}
    assert sums(store) == want
    fresh = str(tmp_path / "fresh")
    stats.compact(spark, store, fresh)
    assert sums(fresh) == want
    # the stream goes on in the compacted store with the checkpoint it has
    assert stats.run_of(spark, fresh, "cp-2") == again
    stats.write_deltas(deltas(spark, "m", 2), fresh, 1, again)
    assert sums(fresh) == {("2024-01-01", 5.0): 1, ("2023-12-31", 21.0): 1}


def test_upsert_leaves_no_views(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    df = spark.createDataFrame([(1, 1, "x")], "id int, seq bigint, v string")
    with pytest.raises(Exception):  # no catalog here takes a MERGE
        tables.upsert(df, "nowhere", ["id"], "seq")
    assert {t.name for t in spark.catalog.listTables()} == before
