"""Write a keyed folder (see ``sources.keyed``): upserts and deletes as new sorted runs.

A batch is written as a run of its own and becomes part of the table by one rename of a manifest, so a
writer that stops anywhere leaves the last committed version in place; what it left is swept by a later
commit. Runs of like size are then merged into one, as in a log-structured table: a run stays apart only
while it is larger than all newer ones together. A row is written again each time its run doubles, so
what a batch writes follows the batch, and a reader merges few runs: their number grows with the
logarithm of the table. A table has one writer at a time; a second one fails at its rename.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.operators.replication import latest_images
from fleetpulse.sources.keyed import (
    GONE,
    MANIFESTS,
    Files,
    Manifest,
    Run,
    images,
    keyed_rows,
    manifest,
    manifest_name,
    newest,
    versions,
)

#: A run is merged with newer ones that together reach this share of its size.
RATIO = 1.0
#: Versions that readers may still go by, and bytes of a run's file.
KEPT_VERSIONS, FILE_BYTES = 8, 256 << 20


def _write_run(rows: DataFrame, files: Files, keys: list[str], size: int) -> Run | None:
    """Rows as a new run in key order, in files of bounded size; None if there are none."""
    folder = f"run-{uuid.uuid4().hex}"
    parts = max(1, math.ceil(size / FILE_BYTES))
    dealt = rows.repartition(parts, *keys) if parts > 1 else rows.coalesce(1)
    dealt.sortWithinPartitions(*keys).write.parquet(f"{files.root}/{folder}")
    n = rows.sparkSession.read.schema(rows.schema).parquet(f"{files.root}/{folder}").count()
    if not n:
        files.delete(folder)
        return None
    return Run(folder, files.size(folder), n)


def _commit(files: Files, before: Manifest | None, table: Manifest) -> Manifest:
    """Make ``table`` the newest version, if ``before`` still is."""
    version = before.version + 1 if before else 1
    table = Manifest(version, table.keys, table.seq, table.schema, table.runs)
    aside = f"{MANIFESTS}/writing-{uuid.uuid4().hex}"
    files.write(aside, table.text())
    files.rename(aside, manifest_name(version))
    return table


def _merge_tail(spark: SparkSession, files: Files, table: Manifest, ratio: float) -> Manifest:
    """Merge the newest runs as long as the next older one is no larger than they are together."""
    runs = table.runs
    begin, together = len(runs) - 1, runs[-1].bytes if runs else 0
    while begin > 0 and runs[begin - 1].bytes <= ratio * together:
        begin -= 1
        together += runs[begin].bytes
    if begin >= len(runs) - 1:
        return table
    rows = newest(images(spark, files.root, table, runs[begin:]), table)
    if begin == 0:  # nothing older that a deletion would hide
        rows = rows.filter(f"NOT coalesce({GONE}, false)")
    merged = _write_run(rows, files, list(table.keys), together)
    kept = runs[:begin] + ((merged,) if merged else ())
    return _commit(files, table, Manifest(0, table.keys, table.seq, table.schema, kept))


def sweep(files: Files, kept_versions: int = KEPT_VERSIONS) -> None:
    """Delete old versions, and the folders that no version left needs."""
    found = versions(files)
    kept = found[-kept_versions:]
    needed = {r.folder for v in kept for r in manifest(files, v).runs}
    for version in found[:-kept_versions]:
        files.delete(manifest_name(version))
    for name in files.names(""):
        if name.startswith("run-") and name not in needed:
            files.delete(name)
    for name in files.names(MANIFESTS):
        if name.startswith("writing-"):
            files.delete(f"{MANIFESTS}/{name}")


def _add_run(
    spark: SparkSession, rows: DataFrame, target: str, keys: list[str], seq: str, ratio: float
) -> None:
    files = Files(spark, target)
    before = manifest(files)
    layout = rows.drop(GONE).schema.json()
    if before and (list(before.keys), before.seq) != (list(keys), seq):
        raise ValueError(f"{target} is kept by {before.keys} and {before.seq}")
    run = _write_run(rows, files, keys, 0)
    if run is None:
        return
    runs = (before.runs if before else ()) + (run,)
    table = _commit(files, before, Manifest(0, tuple(keys), seq, layout, runs))
    _merge_tail(spark, files, table, ratio)
    sweep(files)


def upsert(df: DataFrame, target: str, keys: list[str], seq: str, ratio: float = RATIO) -> None:
    """Apply a batch of changes: the newest image of each key by ``seq``.

    An older change never replaces a newer row, so applying a batch again changes nothing.
    """
    rows = latest_images(df, keys, seq).withColumn(GONE, F.lit(False))
    _add_run(df.sparkSession, rows, target, keys, seq, ratio)


def delete(spark: SparkSession, target: str, ids: DataFrame, key: str,
           ratio: float = RATIO) -> None:
    """Delete the rows whose ``key`` is in ``ids``; a newer change of a deleted key counts again."""
    table = manifest(Files(spark, target))
    if table is None:
        return
    wanted = ids.select(F.col(key).alias("_gone_key")).distinct()
    rows = keyed_rows(spark, target, table.version)
    found = rows.join(wanted, F.col(key) == F.col("_gone_key"), "left_semi")
    told = [*table.keys, table.seq]
    marks = found.select(*(F.col(c) if c in told else F.lit(None).cast(found.schema[c].dataType)
                           .alias(c) for c in found.columns), F.lit(True).alias(GONE))
    _add_run(spark, marks, target, list(table.keys), table.seq, ratio)
