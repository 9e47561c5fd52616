"""The statistics store: runs that read a topic again, and what each of them serves."""

import json
import re
from datetime import date, datetime, timedelta

import pytest
from helpers import run_available, write_topic
from pyspark.sql import functions as F

from fleetpulse.operators.workflow_stats import SUCCESS_PODS
from fleetpulse.plans import jobs
from fleetpulse.sinks import stats
from fleetpulse.sinks.stats import Coverage, served
from fleetpulse.sources.lake import lake_table

DAY = datetime(2024, 3, 1)


def topic(spark, folder, counts, extra=(), parts=3, start=None):
    """``counts[d]`` workflows succeed over day d, evenly; ``extra`` are (arrival, day) of others."""
    made = []
    for d, n in enumerate(counts):
        made += [(DAY + timedelta(days=d, hours=24 * i / n, minutes=1),) * 2 for i in range(n)]
    made += list(extra)
    made.sort()
    rows = [(i, at, json.dumps({
        "workflow_id": f"w{i}", "workflow_type": "convert", "category": "c",
        "workflow_status": "SUCCESS", "update_time": f"{of:%Y-%m-%d %H:%M:%S}"}))
        for i, (at, of) in enumerate(made)]
    raw = spark.createDataFrame(rows, "seq long, record_ts timestamp, value string")
    return jobs.Topic(write_topic(raw, str(folder), parts), files_per_trigger=1, start=start)


def run(spark, source, tmp_path, checkpoint, records=None):
    run_available(jobs.workflow_statistics(
        spark, source, str(tmp_path / "store"), str(tmp_path / checkpoint), records=records))
    return str(tmp_path / "store")


def successes(spark, store, days=None):
    got = stats.read_statistics(spark, store, days).filter(F.col("name") == SUCCESS_PODS)
    return {(r[0] - DAY.date()).days + 1: r[1]
            for r in got.groupBy("stat_date").agg(F.sum("value")).collect()}


def test_a_new_run_leaves_older_days_alone(spark, tmp_path):
    """One record of day 1 comes on day 2; a run from day 2 on must not take day 1 over for it."""
    late = (DAY + timedelta(days=1, hours=5), DAY + timedelta(hours=23))
    whole = topic(spark, tmp_path / "in", [10, 5, 3], [late])
    store = run(spark, whole, tmp_path, "first")
    assert successes(spark, store) == {1: 11, 2: 5, 3: 3}
    again = jobs.Topic(whole.name, files_per_trigger=1, start=jobs.day_before(date(2024, 3, 3)))
    run(spark, again, tmp_path, "second")
    assert successes(spark, store) == {1: 11, 2: 5, 3: 3}
    assert [c.run for c in stats.coverages(spark, store)] == [1, 0]
    days = [date(2024, 3, 1)]
    assert successes(spark, store, days) == {1: 11}
    stats.compact(spark, store, f"{store}-fresh")
    assert successes(spark, f"{store}-fresh") == {1: 11, 2: 5, 3: 3}


def test_a_start_at_the_latest_keeps_the_hours_before(spark, tmp_path):
    first = topic(spark, tmp_path / "one", [8])
    store = run(spark, first, tmp_path, "first", str(tmp_path / "records"))
    # later records only, of the same day and of the next, under a new checkpoint
    rest = [(DAY + timedelta(hours=23, minutes=m),) * 2 for m in (30, 40)]
    rest += [(DAY + timedelta(days=1, hours=h),) * 2 for h in (1, 2, 3)]
    second = topic(spark, tmp_path / "two", [], rest, parts=2)
    run(spark, second, tmp_path, "second", str(tmp_path / "records"))
    assert successes(spark, store) == {1: 10, 2: 3}
    infos = lake_table(spark, str(tmp_path / "records")).filter("stat_date LIKE '2024-03-01%'")
    assert '{"convert":10}' in {r.info for r in infos.collect()}


def test_a_replay_under_way_serves_nothing_yet(spark, tmp_path):
    whole = topic(spark, tmp_path / "in", [6, 6], parts=4)
    store = run(spark, whole, tmp_path, "first")
    part = topic(spark, tmp_path / "part", [6], parts=1)
    again = jobs.Topic(part.name, start=DAY)
    run(spark, again, tmp_path, "second")  # has read day 1, but not what came on day 2
    plan = served(date(2024, 3, 1), stats.coverages(spark, store))
    assert plan == [(0, None, None)]
    assert successes(spark, store) == {1: 6, 2: 6}


def test_only_the_asked_days_are_read(spark, tmp_path):
    store = run(spark, topic(spark, tmp_path / "in", [3, 3, 3, 3]), tmp_path, "first")
    plan = stats._valid(spark, store, [date(2024, 3, 2)])._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^]]*stat_date", plan)


H = timedelta(hours=1)


def test_the_first_hour():
    """A run's first record is not at midnight sharp; one that joins an older run adds to it."""
    old, late = DAY + timedelta(minutes=3), DAY + timedelta(minutes=40)
    day = DAY.date()
    alone = Coverage(0, old, DAY + 60 * H)
    assert served(day, [alone]) == [(0, None, None)]
    assert served(day, [Coverage(1, DAY, DAY + 9 * H), alone]) == [(0, None, None)]
    assert served(day, [Coverage(1, DAY, DAY + 61 * H), alone]) == [(1, None, None)]
    stopped = Coverage(0, old, DAY + timedelta(minutes=20))
    assert served(day, [Coverage(1, late, DAY + 60 * H), stopped]) == [
        (0, None, DAY + H), (1, None, None)]
    assert served(day, []) == []


def brute(day, runs, rows):
    """Rows (arrival, row id) that count when each hour goes to the runs that serve it."""
    out = []
    for number, since, to in served(day, runs):
        own = next(r for r in runs if r.run == number)
        out += [i for at, i in rows if own.first <= at <= own.last
                and (since is None or at.replace(minute=0) >= since)
                and (to is None or at.replace(minute=0) < to)]
    return sorted(out)


@pytest.mark.parametrize("spans", [
    [(0, 60)], [(0, 60), (0, 60)], [(0, 60), (24, 60)], [(0, 30), (30, 60)], [(0, 20), (6, 60)],
    [(0, 20), (6, 12)], [(0, 10), (11, 20), (15, 60)], [(0, 60), (2, 50)], [(3, 40), (0, 60)],
    [(0, 10), (5, 30), (20, 60)], [(5, 60), (0, 8)]])
def test_every_row_counts_once(spans):
    """Rows on the half hour, runs that begin and end on the hour: nothing is lost or counted twice."""
    rows = [(DAY + (k + 0.5) * H, k) for k in range(0, 61)]
    runs = [Coverage(n, DAY + a * H, DAY + b * H + 0.75 * H) for n, (a, b) in enumerate(spans)][::-1]
    read = {i for at, i in rows if any(r.first <= at <= r.last for r in runs)}
    for d in (0, 1, 2):
        day = DAY.date() + timedelta(days=d)
        reach = [(at, i) for at, i in rows
                 if DAY + timedelta(days=d) <= at < DAY + timedelta(days=d + 2)]
        assert brute(day, runs, reach) == sorted(i for _, i in reach if i in read), (d, spans)
