import json
import random
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetpulse import schemas
from fleetpulse.functions import nested, payload, text, times
from fleetpulse.operators import bag_stats, summary
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.sinks import topics as topic_sinks
from fleetpulse.sources import topics


def one(spark, column, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} string" for n in names))
    return df.select(column).first()[0]


@pytest.mark.parametrize("text, unit, begin, epoch", [
    ("2024-02-29 23:59:58", "minute", "2024-02-29 23:59:00", 1709251140),
    ("2024-02-29 23:59:58", "day", "2024-02-29 00:00:00", 1709164800),
    ("2024-02-29 23:59:58", "week", "2024-02-26 00:00:00", 1708905600),
    ("2024-02-29 23:59:58", "month", "2024-02-01 00:00:00", 1706745600),
    ("2024-12-30 00:00:00", "week", "2024-12-30 00:00:00", 1735516800),
    ("2025-01-05 12:00:00", "week", "2024-12-30 00:00:00", 1735516800),
    ("2023-12-31 23:00:00", "month", "2023-12-01 00:00:00", 1701388800),
])
def test_buckets(spark, text, unit, begin, epoch):
    df = spark.createDataFrame([(text,)], "t string")
    ts = times.parse_text(F.col("t"))
    row = df.select(times.bucket(ts, unit), times.bucket_text(ts, unit),
                    times.bucket_epoch(ts, unit)).first()
    assert (str(row[0]), row[1], row[2]) == (begin, begin, epoch)


@pytest.mark.parametrize("text", ["", "soon", "2024-13-01 00:00:00", "2024-02-30 00:00:00", None,
                                  "2024-02-29", "2024-02-29 1:2:3", "2024-02-29 23:59:58.5"])
def test_malformed_times_are_null(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(times.parse_text(F.col("t"))).first()[0] is None


def test_unknown_unit():
    with pytest.raises(ValueError):
        times.bucket(None, "year")


def test_epoch_forms(spark):
    df = spark.createDataFrame([("1704067200123", 1704067200.5, "oops")],
                               "ms string, s double, bad string")
    row = df.select(
        times.epoch_seconds(times.from_epoch_millis_text(F.col("ms"))),
        times.epoch_seconds(times.from_epoch_seconds(F.col("s"))),
        times.from_epoch_millis_text(F.col("bad")),
        times.shift_zone(F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz"), "UTC",
                         "Asia/Shanghai"),
    ).first()
    assert tuple(row) == (1704067200.123, 1704067200.5, None, datetime(2024, 1, 1, 8))


FALSY = [None, "", 0, 0.0, -0.0, False, [], {}]
TRUTHY = ["a", "0", " ", 1, -1, 0.5, True, [0], {"a": None}, "null", "false", 1e-9]


def test_truthy_bags(spark):
    bags = FALSY + TRUTHY
    body = json.dumps({"bag_replayed_list": bags})
    counts = payload.count_bags(payload.bag_list(F.col("j")))
    assert tuple(one(spark, counts, j=body)) == (len(TRUTHY), len(FALSY))
    for raw in ("0.00", "0e3", "-0", "0E-2"):
        got = one(spark, counts, j='{"bag_replayed_list":[%s]}' % raw)
        assert tuple(got) == (0, 1), raw
    for absent in ("{}", '{"x":1}', None, "broken"):
        assert tuple(one(spark, counts, j=absent)) == (0, 0)


def test_payload_fields(spark):
    config = '{"extra_args":{"mode":"Fast"}}'
    assert one(spark, payload.mode_of(F.col("j")), j=config) == "Fast"
    assert one(spark, payload.mode_of(F.col("j")), j='{"extra_args":{}}') is None
    assert one(spark, payload.duration_of(F.col("j")), j='{"bag_duration":2.5}') == 2.5
    assert one(spark, payload.duration_of(F.col("j")), j='{"bag_duration":"x"}') is None
    assert one(spark, payload.profile_of(F.col("j")), j='{"bags_profile_summary":null}') is None


def test_rejects(spark):
    df = spark.createDataFrame(
        [(1, "{}", "{}"), (2, None, "{}"), (3, "{}", "{bad")], "id int, a string, b string")
    good, bad = payload.split_rejects(df, ["a", "b"])
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_text_rules(spark):
    tag = text.first_match_tag(F.col("t"))
    assert [one(spark, tag, t=t) for t in ("xC B", "A", "zzC", "", None)] == [
        "B", "A", "C", "D", "D"]
    level = text.probe_level(F.col("t"))
    assert [one(spark, level, t=t) for t in ("some Err! here", "ERR", None)] == [
        "fault", "health", "health"]
    assert one(spark, text.name_part(F.col("t"), 3), t="a-b-c-w-replay") == "w"
    assert one(spark, text.name_part(F.col("t"), 4), t="a-b") is None
    assert one(spark, text.map_values(F.col("t"), text.GROUP_ALIASES), t="cp") == "CP"
    assert one(spark, text.map_values(F.col("t"), text.GROUP_ALIASES), t=None) is None


def test_percent_difference(spark):
    df = spark.createDataFrame([(33, 32), (3, 0), (0, 4)], "a bigint, b bigint")
    got = [r[0] for r in df.select(text.percent_difference(F.col("a"), F.col("b"))).collect()]
    assert got == [3.12, None, -100.0]


@pytest.mark.parametrize("how,want", [
    (nested.add_at_path, {"a": 4.0, "b.c": 2.0}), (None, {"a": 3.0, "b.c": 2.0})])
def test_paths(spark, how, want):
    df = spark.createDataFrame(
        [(1, ["a"], 1.0), (2, ["a"], 3.0), (1, ["b", "c"], 2.0)],
        "seq int, path array<string>, value double").withColumn("k", F.lit("k"))
    out = how(df, ["k"]) if how else nested.overwrite_at_path(df, ["k"], "seq")
    assert {".".join(r.path): r.value for r in out.collect()} == want


def test_nest_to_json(spark):
    rnd = random.Random(4)
    want, history = {}, []
    for k in ("x", 'quote"d', None):
        tree = {}
        for _ in range(30):
            path = [rnd.choice(['a', 'b"\\', 'ü']) + str(d) for d in range(rnd.randrange(1, 5))]
            path[-1] += "leaf"
            value = rnd.choice([1.0, 2.5, -3.0, 1e7, 0.1])
            node = tree
            for p in path[:-1]:
                node = node.setdefault(p, {})
            if path[-1] not in node:
                node[path[-1]] = value
                history.append((k, path, value))
        want[k] = tree
    df = spark.createDataFrame(history, "k string, path array<string>, value double")
    got = {r.k: json.loads(r.info) for r in nested.nest_to_json(df, ["k"], 4).collect()}
    assert got == want
    with pytest.raises(Exception, match="longer than 3"):
        nested.nest_to_json(df, ["k"], 3).collect()


def test_statistics_records(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "s", ["replay"], 2.0), ("2024-01-02", "s", ["null"], 0.0)],
        "d string, name string, path array<string>, value double",
    ).select(F.to_date("d").alias("stat_date"), "name", "path", "value")
    assert rows(wf.records(df)) == {
        ("s", "daily", "2024-01-02 00:00:00", '{"null":0,"replay":2}'): 1}


def test_decode(spark):
    raw = spark.createDataFrame(
        [(1, '{"node_name":"n","extra":1}'), (2, "not json"), (3, '{"timestamp":"5"}')],
        "seq bigint, value string")
    decoded = topics.decode(raw, schemas.JOB_MESSAGE)
    assert [(r.seq, r.node_name, r.timestamp) for r in topics.good(decoded).collect()] == [
        (1, "n", None), (3, None, "5")]
    assert [tuple(r) for r in topics.corrupt(decoded).collect()] == [(2, "not json")]
    with pytest.raises(Exception, match="(?i)malformed"):
        topics.decode(raw, schemas.JOB_MESSAGE, "FAILFAST").collect()


def test_null_rules(spark):
    pods = spark.createDataFrame([("SUCCESS",), ("FAILURE",), (None,)], "status string")
    assert sorted(str(r[0]) for r in summary.not_successful(pods).collect()) == ["FAILURE", "None"]
    bags = spark.createDataFrame(
        [("replay", "FAILURE", None), ("replay", "FAILURE", ""), ("convert", "FAILURE", "t"),
         ("replay", "SUCCESS", "t"), (None, "FAILURE", "t")],
        "type string, status string, backtrace string")
    assert [r.backtrace for r in summary.crashes(bags).collect()] == [""]


def test_bag_null_rules(spark):
    """A missing output or error type counts; an empty mode does not, a missing group does."""
    df = spark.createDataFrame(
        [(None, "", 1.0, "", None), ("x", None, 2.0, "m", "g"), ("", "E", 4.0, "m", "g"),
         ("x", "", None, "m", "g")],
        "output_bag string, error_type string, duration double, mode string, `group` string",
    ).withColumns({"error_stage": F.lit("s"), "stat_date": F.lit("2024-01-01").cast("date")})
    got = {(r.name, ".".join(r.path)): r.value for r in bag_stats.statistics(df).collect()}
    assert got == {
        (bag_stats.DURATION_BY_GROUP, "null"): 1.0, (bag_stats.DURATION_BY_GROUP, "g"): 2.0,
        (bag_stats.DURATION_BY_MODE, "m"): 2.0,
        (bag_stats.ERRORS_BY_GROUP, "g.s.null"): 1.0, (bag_stats.ERRORS_BY_GROUP, "g.s.E"): 1.0}


def test_json_rows_keep_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert topic_sinks.to_json_rows(df).first()[0] == '{"a":1,"b":null}'
