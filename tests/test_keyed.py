"""Keyed folders: a model of upserts and deletes, writers that stop anywhere, and bytes written."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from fleetpulse.sinks import keyed, tables
from fleetpulse.sources.keyed import Files, keyed_rows, manifest, versions
from fleetpulse.sources.lake import lake_table

SCHEMA = "id int, seq bigint, v string"


def batch(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_random_changes_against_a_model(spark, tmp_path):
    r, target, model, seq = random.Random(7), str(tmp_path / "t"), {}, 0
    for step in range(14):
        if step % 5 == 4 and model:
            gone = r.sample(sorted(model), min(6, len(model)))
            keyed.delete(spark, target, batch(spark, [(i, 0, "") for i in gone]), "id")
            for i in gone:
                del model[i]
        else:
            data = []
            for _ in range(r.randrange(1, 30)):
                seq += 1
                data.append((r.randrange(40), seq, f"v{seq}"))
            keyed.upsert(batch(spark, data), target, ["id"], "seq")
            model.update({i: (n, v) for i, n, v in data})
        got = {x.id: (x.seq, x.v) for x in lake_table(spark, target).collect()}
        assert got == model
    # an older change replaces nothing
    old = [(i, 0, "old") for i in sorted(model)[:5]]
    keyed.upsert(batch(spark, old), target, ["id"], "seq")
    assert {x.id: (x.seq, x.v) for x in lake_table(spark, target).collect()} == model
    files = Files(spark, target)
    assert len(versions(files)) <= keyed.KEPT_VERSIONS
    assert len(manifest(files).runs) <= 5
    # readers can go back to a version that is kept
    assert keyed_rows(spark, target, versions(files)[0]).count() > 0


class Stopped(Exception):
    pass


STEPS = ["write", "rename", "delete"]


def stop_after(monkeypatch, step, calls):
    """The writer ends after so many calls of a step of the file system, before or after it."""
    left = [calls]
    plain = getattr(Files, step)

    def call(self, *args):
        left[0] -= 1
        if left[0] == 0:
            raise Stopped
        out = plain(self, *args)
        return out

    monkeypatch.setattr(Files, step, call)


@pytest.mark.parametrize("step,calls", [("write", 1), ("rename", 1), ("size", 1), ("write", 2),
                                        ("rename", 2), ("delete", 1), ("delete", 2), ("names", 2)])
def test_a_writer_that_stops_loses_nothing(spark, tmp_path, monkeypatch, step, calls):
    target = str(tmp_path / "t")
    first = [(i, i, "a") for i in range(20)]
    second = [(i, 100 + i, "b") for i in range(10, 30)]
    keyed.upsert(batch(spark, first), target, ["id"], "seq")
    old = {(i, i, "a"): 1 for i in range(20)}
    new = {(i, 100 + i, "b") if i >= 10 else (i, i, "a"): 1 for i in range(30)}
    with monkeypatch.context() as patch:
        stop_after(patch, step, calls)
        try:
            keyed.upsert(batch(spark, second), target, ["id"], "seq")
        except Stopped:
            pass
    assert rows(lake_table(spark, target)) in (old, new)
    keyed.upsert(batch(spark, second), target, ["id"], "seq")
    assert rows(lake_table(spark, target)) == new
    keyed.sweep(Files(spark, target), 1)
    needed = {r.folder for r in manifest(Files(spark, target)).runs}
    assert {n for n in Files(spark, target).names("") if n.startswith("run-")} == needed
    assert rows(lake_table(spark, target)) == new


def test_two_writers(spark, tmp_path):
    target = str(tmp_path / "t")
    keyed.upsert(batch(spark, [(1, 1, "a")]), target, ["id"], "seq")
    files = Files(spark, target)
    before = manifest(files)
    keyed.upsert(batch(spark, [(2, 2, "b")]), target, ["id"], "seq")
    with pytest.raises(FileExistsError):
        keyed._commit(files, before, before)
    with pytest.raises(ValueError, match="is kept by"):
        keyed.upsert(batch(spark, [(2, 2, "b")]), target, ["v"], "seq")


def test_bytes_follow_the_batches(spark, tmp_path, monkeypatch):
    """A table of 20,000 rows takes 24 batches of 100; what they write is far from 24 tables."""
    target, seen = str(tmp_path / "t"), []
    plain = keyed._write_run

    def counted(*args):
        run = plain(*args)
        seen.append(run.bytes)
        return run

    monkeypatch.setattr(keyed, "_write_run", counted)
    big = spark.range(20_000).select(F.col("id").cast("int"), F.col("id").alias("seq"),
                                     F.md5(F.col("id").cast("string")).alias("v"))
    keyed.upsert(big, target, ["id"], "seq")
    whole = seen.pop()
    for n in range(24):
        change = spark.range(100).select(
            ((F.col("id") * 197 + n) % 20_000).cast("int").alias("id"),
            (F.col("id") + 20_000 + 100 * n).alias("seq"),
            F.md5((F.col("id") + n).cast("string")).alias("v"))
        keyed.upsert(change, target, ["id"], "seq")
    runs = manifest(Files(spark, target)).runs
    assert runs[0].bytes == whole  # the large run was never written again
    assert sum(seen) < whole and len(runs) <= 7
    assert lake_table(spark, target).count() == 20_000


@pytest.mark.parametrize("calls", [1, 2])
def test_a_delete_in_days_that_stops_is_finished(spark, tmp_path, monkeypatch, calls):
    target, staging = str(tmp_path / "t"), str(tmp_path / "staging")
    data = [(i, "abc"[i % 3], "v") for i in range(30)]
    schema = "id int, day string, v string"
    tables.overwrite_parts(spark.createDataFrame(data, schema), target, ["day"])
    gone = spark.createDataFrame([(i, "", "") for i in range(30) if i % 3 == 0 or i == 4], schema)
    left = [calls]
    plain = tables.overwrite_parts

    def half(df, to, parts):
        """Dynamic overwrite drops the old partitions first: here it ends right after that."""
        left[0] -= 1
        if left[0] == 0:
            tables._drop_parts(spark, to, ["day=b"])
            raise Stopped
        plain(df, to, parts)

    with monkeypatch.context() as patch:
        patch.setattr(tables, "overwrite_parts", half)
        try:
            tables.delete_keys(spark, target, gone, "id", ["day"], staging)
        except Stopped:
            pass
    tables.delete_keys(spark, target, gone, "id", ["day"], staging)
    assert rows(lake_table(spark, target), "id", "day") == {
        (i, "abc"[i % 3]): 1 for i in range(30) if i % 3 and i != 4}
    assert Files(spark, staging).names("") == []


class Live:
    """A source table and its log; a few changes happen at every call."""

    def __init__(self, spark):
        self.spark, self.r, self.log = spark, random.Random(3), []
        self.rows = {i: (0, "start") for i in range(60)}
        self.reads = []

    def change(self, n):
        for _ in range(n):
            key, at = self.r.randrange(70), len(self.log) + 1
            self.rows[key] = (at, f"v{at}")
            self.log.append((key, at, f"v{at}"))

    def position(self):
        at = len(self.log)
        self.change(3)  # between the position and the read
        return at

    def read(self, lower, upper):
        self.reads.append(lower)
        inside = [(k, v) for k, (_, v) in self.rows.items()
                  if (lower is None or k >= lower) and (upper is None or k < upper)]
        self.change(4)  # between the read and the next position
        return self.spark.createDataFrame(inside, "id int, v string")


def test_scan_beside_a_live_log(spark, tmp_path):
    from fleetpulse.sources.changes import images_of_scan, scan_chunks
    live, target, staging = Live(spark), str(tmp_path / "t"), str(tmp_path / "s")
    live.change(20)
    bounds, stop = [15, 30, 45], [3]

    def position():
        stop[0] -= 1
        if stop[0] == 0:
            raise Stopped
        return live.position()

    with pytest.raises(Stopped):
        scan_chunks(spark, bounds, live.read, position, staging)
    stop[0] = 99
    scan = scan_chunks(spark, bounds, live.read, position, staging)
    assert live.reads == [None, 15, 30, 45]  # the first chunk was not read again
    lows = [r[0] for r in scan.select("low").distinct().collect()]
    assert len(lows) == 4 and scan.filter("high <= low").isEmpty()
    live.change(10)
    after = [c for c in live.log if c[1] > min(lows)]
    # the log may be applied in part before the scan, and again after it
    tables.upsert(batch(spark, after[:15]), target, ["id"], "seq")
    tables.upsert(images_of_scan(scan).select("id", "seq", "v"), target, ["id"], "seq")
    tables.upsert(batch(spark, after), target, ["id"], "seq")
    assert {r.id: r.v for r in lake_table(spark, target).collect()} == {
        k: v for k, (_, v) in live.rows.items()}
