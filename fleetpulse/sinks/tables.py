"""Table writers that can be run again without doubling rows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetpulse.operators.replication import latest_images
from fleetpulse.sinks import keyed
from fleetpulse.sources.keyed import Files, is_keyed
from fleetpulse.sources.lake import is_path, lake_table

BATCH = "batch_id"


def append(df: DataFrame, target: str) -> None:
    if is_path(target):
        df.write.mode("append").parquet(target)
    else:
        df.writeTo(target).append()


def overwrite_parts(df: DataFrame, target: str, parts: list[str]) -> None:
    """Replace exactly the partitions present in ``df``; running it twice changes nothing."""
    if is_path(target):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(target))
    else:
        df.writeTo(target).overwritePartitions()


def overwrite_days(
    df: DataFrame, target: str, time: str, day: str = "day", days: list[date] | None = None
) -> None:
    """Idempotent append of whole days: the day is the partition and is replaced as one.

    Rows are brought together by day before they are written, so a day has few files. ``days`` are
    replaced even where ``df`` has no row of them.
    """
    dated = df.withColumn(day, F.to_date(time))
    overwrite_parts(dated.hint("rebalance", day), target, [day])
    if days:
        empty_days(df.sparkSession, target, day, dated, days)


def empty_days(
    spark: SparkSession, target: str, day: str, written: DataFrame, days: list[date]
) -> None:
    """Empty those of ``days`` that ``written`` has no row of."""
    if not is_path(target):
        for gone in days:
            if written.filter(F.col(day) == F.lit(gone)).isEmpty():
                spark.sql(f"DELETE FROM {target} WHERE `{day}` = DATE '{gone}'")
        return
    present = {r[0] for r in written.filter(F.col(day).isin(days)).select(day).distinct().collect()}
    _drop_parts(spark, target, [f"{day}={d}" for d in days if d not in present])


def drop_days(spark: SparkSession, target: str, day: str, days: list[date]) -> None:
    """Empty whole days, whatever they hold."""
    if is_path(target):
        _drop_parts(spark, target, [f"{day}={d}" for d in days])
        return
    for gone in days:
        spark.sql(f"DELETE FROM {target} WHERE `{day}` = DATE '{gone}'")


def write_batch(df: DataFrame, target: str, batch_id: int) -> None:
    """Rows of one micro-batch; a repeated batch replaces itself."""
    overwrite_parts(df.withColumn(BATCH, F.lit(batch_id).cast("bigint")), target, [BATCH])


def merge_sql(target: str, view: str, columns: list[str], keys: list[str], seq: str | None) -> str:
    """Upsert without deletes. With ``seq`` an older change never replaces a newer row."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    newer = f" AND (t.`{seq}` IS NULL OR s.`{seq}` > t.`{seq}`)" if seq else ""
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns if c not in keys)
    names = ", ".join(f"`{c}`" for c in columns)
    values = ", ".join(f"s.`{c}`" for c in columns)
    return (f"MERGE INTO {target} t USING {view} s ON {on} "
            f"WHEN MATCHED{newer} THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})")


def upsert(df: DataFrame, target: str, keys: list[str], seq: str) -> None:
    """Apply one batch of changes, newest row per key; the table always holds the current rows.

    A catalog table gets a MERGE, a folder a new run (see ``sinks.keyed``). Applying a batch again
    changes nothing, also after a writer that stopped anywhere.
    """
    if is_path(target):
        keyed.upsert(df, target, keys, seq)
        return
    newest = latest_images(df, keys, seq)
    spark = df.sparkSession
    view = f"_changes_{uuid.uuid4().hex}"
    newest.createOrReplaceTempView(view)
    try:
        spark.sql(merge_sql(target, view, newest.columns, keys, seq))
    finally:
        spark.catalog.dropTempView(view)


def current(spark: SparkSession, target: str) -> DataFrame:
    """The rows of an upserted table."""
    return lake_table(spark, target)


def delete_keys(
    spark: SparkSession, target: str, ids: DataFrame, key: str, parts: list[str],
    staging: str | None = None,
) -> None:
    """Delete the rows whose key is in ``ids``.

    A catalog table gets a DELETE, a keyed folder a run of deletions. In any other partitioned Parquet
    folder the partitions that hold such rows are replaced: what they keep is first written whole to a
    folder of its own under ``staging``, which then gets the mark ``ready``. A run that stops
    while it replaces partitions is finished from there by the next one, so no row is lost.
    """
    if not is_path(target):
        view = f"_deleted_{uuid.uuid4().hex}"
        ids.select(F.col(key)).createOrReplaceTempView(view)
        try:
            spark.sql(f"DELETE FROM {target} WHERE `{key}` IN (SELECT `{key}` FROM {view})")
        finally:
            spark.catalog.dropTempView(view)
        return
    if is_keyed(spark, target):
        keyed.delete(spark, target, ids, key)
        return
    if staging is None:
        raise ValueError("a Parquet target needs a staging folder")
    finish_deletes(spark, target, staging, parts)
    files = Files(spark, staging)
    own = uuid.uuid4().hex
    rows = lake_table(spark, target)
    wanted = ids.select(F.col(key).alias("_gone")).distinct()
    touched = rows.join(wanted, F.col(key) == F.col("_gone"), "left_semi").select(*parts).distinct()
    affected = rows.join(touched, parts, "left_semi")
    kept = affected.join(wanted, F.col(key) == F.col("_gone"), "left_anti")
    kept.hint("rebalance", *parts).write.option("partitionOverwriteMode", "static").partitionBy(
        *parts).parquet(f"{staging}/{own}/kept")
    touched.write.parquet(f"{staging}/{own}/touched")
    spark.createDataFrame([(rows.schema.json(),)], "layout string").coalesce(1).write.text(
        f"{staging}/{own}/layout")
    files.write(f"{own}/writing", "")
    files.rename(f"{own}/writing", f"{own}/ready")
    finish_deletes(spark, target, staging, parts)


def finish_deletes(spark: SparkSession, target: str, staging: str, parts: list[str]) -> None:
    """Replace the partitions of every run that is ready under ``staging``, and drop what it staged.

    What runs that never became ready have left is dropped too: they have changed nothing.
    """
    files = Files(spark, staging)
    for own in files.names(""):
        if files.exists(f"{own}/ready"):
            _replace_parts(spark, target, f"{staging}/{own}", parts)
        files.delete(own)


def _replace_parts(spark: SparkSession, target: str, staging: str, parts: list[str]) -> None:
    layout = StructType.fromJson(json.loads(spark.read.text(f"{staging}/layout").first()[0]))
    kept = spark.read.schema(layout).parquet(f"{staging}/kept")
    overwrite_parts(kept, target, parts)
    # partitions that lost all their rows
    emptied = spark.read.parquet(f"{staging}/touched").join(
        kept.select(*parts).distinct(), parts, "left_anti")
    _drop_parts(spark, target, [
        "/".join(f"{p}={row[p]}" for p in parts) for row in emptied.toLocalIterator()])


def _drop_parts(spark: SparkSession, target: str, folders: list[str]) -> None:
    """Drop partition folders of a Parquet table; one list entry for each partition."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    for name in folders:
        folder = fs_path(f"{target}/{name}")
        folder.getFileSystem(conf).delete(folder, True)


def each_batch(apply: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that skips empty batches."""
    def run(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            apply(df, batch_id)
    return run
