"""Change rows to current rows: deletes are ignored, the newest image per key wins.

A change row is ``(op, seq, before, after)``; ``op`` is ``r`` (snapshot), ``c`` (insert), ``ub`` and
``u`` (old and new image of an update) or ``d``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Change kinds, and the column the lake table calls by another name.
SNAPSHOT, INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "r", "c", "ub", "u", "d"
LAKE_RENAMES = {"tag": "_tag"}


def drop_deletes(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("op") != DELETE)


def images(changes: DataFrame) -> DataFrame:
    """``(seq, row)``: the row image each change carries."""
    row = F.when(F.col("op") == UPDATE_BEFORE, F.col("before")).otherwise(F.col("after"))
    return drop_deletes(changes).select("seq", row.alias("row"))


def latest_images(rows: DataFrame, keys: list[str], seq: str = "seq") -> DataFrame:
    """The newest row per key, from flat rows with a sequence column (kept).

    ``max_by`` is combined before the shuffle: a key with many changes sends one row per task.
    ``seq`` must be distinct within a key.
    """
    rest = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("_row"))
    return newest.select(*keys, "_row.*").select(*rows.columns)


def current_rows(changes: DataFrame, keys: list[str]) -> DataFrame:
    flat = images(changes).select("seq", "row.*")
    return latest_images(flat, keys).drop("seq")


def with_snapshot(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """A full table scan placed ahead of its change log."""
    after = changes.schema["after"].dataType
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in after.fields]
    first = snapshot.select(
        F.lit(SNAPSHOT).alias("op"), F.lit(-1).cast("bigint").alias("seq"),
        F.lit(None).cast(after).alias("before"), F.struct(*cols).cast(after).alias("after"))
    return first.unionByName(changes.select("op", "seq", "before", "after"))


def whole_number(c: Column) -> Column:
    """Rounded half away from zero."""
    return F.round(c).cast("int")


def to_lake_workflow(rows: DataFrame) -> DataFrame:
    """Source layout to lake layout: ``tag`` is renamed and ``upload_ttl`` is a whole number."""
    out = [
        whole_number(F.col(c)).alias(c) if c == "upload_ttl"
        else F.col(c).alias(LAKE_RENAMES.get(c, c))
        for c in rows.columns
    ]
    return rows.select(*out)


def times_as_text(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Timestamps as text with a fixed six-digit fraction."""
    return rows.withColumns(
        {c: F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in columns})
