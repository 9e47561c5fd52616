"""Two-sided comparison of counts, fields and statistics."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import text
from fleetpulse.operators import bag_stats, workflow_stats

# Fixed value: statistics of this environment are live figures, not daily records.
LIVE_PREFIX = "REALTIME"


def bucket_counts(df: DataFrame, time: str, unit: str = "day") -> DataFrame:
    return df.groupBy(F.date_trunc(unit, F.col(time)).cast("timestamp_ntz").alias("bucket")).agg(
        F.count("*").alias("n"))


def compare_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(bucket, n_left, n_right, match)`` from two sides already counted per bucket."""
    r = right.select(F.col("bucket").alias("_bucket"), F.col("n").alias("_n"))
    return left.join(r, F.col("bucket").eqNullSafe(F.col("_bucket")), "full_outer").select(
        F.coalesce("bucket", "_bucket").alias("bucket"),
        F.coalesce("n", F.lit(0)).alias("n_left"),
        F.coalesce("_n", F.lit(0)).alias("n_right"),
    ).withColumn("match", F.col("n_left") == F.col("n_right"))


def compare_fields(
    left: DataFrame,
    right: DataFrame,
    key: str,
    columns: list[str],
    rename: Mapping[str, str] | None = None,
    left_transform: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Differing fields as ``(key, column, left_value, right_value)``.

    ``rename`` maps left column names to right ones; ``left_transform`` brings a left column to the
    right side's form first. A key on one side only is one row with column ``<missing left>`` or
    ``<missing right>``.
    """
    rename, left_transform = rename or {}, left_transform or {}
    same = lambda c: c
    l = left.select(F.col(key).alias("_lk"), F.struct(
        *[left_transform.get(c, same)(F.col(c)).alias(c) for c in columns]).alias("_l"))
    r = right.select(F.col(key).alias("_rk"), F.struct(
        *[F.col(rename.get(c, c)).alias(c) for c in columns]).alias("_r"))
    joined = l.join(r, F.col("_lk") == F.col("_rk"), "full_outer")

    def row(name, a, b):
        return F.struct(F.lit(name).alias("column"), a.cast("string").alias("left_value"),
                        b.cast("string").alias("right_value"))

    lacks = F.lit(None)
    diffs = F.array_compact(F.array(*[
        F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")),
               row(c, F.col(f"_l.{c}"), F.col(f"_r.{c}"))) for c in columns]))
    found = (
        F.when(F.col("_lk").isNull(), F.array(row("<missing left>", lacks, F.col("_rk"))))
        .when(F.col("_rk").isNull(), F.array(row("<missing right>", F.col("_lk"), lacks)))
        .otherwise(diffs)
    )
    return joined.select(F.coalesce("_lk", "_rk").alias(key), F.inline(found))


def daily_records(statistics: DataFrame, start: str, end: str, skip_live: bool = False) -> DataFrame:
    """Daily records of a half-open date range."""
    rows = statistics.filter(
        (F.col("period") == "daily") & (F.col("stat_date") >= start) & (F.col("stat_date") < end))
    if skip_live:
        rows = rows.filter(~F.col("name").startswith(LIVE_PREFIX))
    return rows


def totals(records: DataFrame) -> DataFrame:
    """Sum of each record's numbers over days: ``(name, key, value)``.

    The nested error counts are left out. The time profile is reduced to its grand total, with the
    device as name and the category as key.
    """
    is_profile = F.col("name") == workflow_stats.TIME_CONSUMING
    top = F.map_entries(F.from_json("info", "map<string,variant>"))
    numeric = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
    plain = F.transform(
        F.filter(top, lambda e: F.schema_of_variant(e["value"]).rlike(numeric)),
        lambda e: F.struct(F.col("name").alias("name"), e["key"].alias("key"),
                           F.try_variant_get(e["value"], "$", "double").alias("value")))
    profile = F.flatten(F.transform(
        F.map_entries(F.from_json("info", "map<string,map<string,variant>>")),
        lambda d: F.transform(
            F.map_entries(d["value"]),
            lambda g: F.struct(
                d["key"].alias("name"), g["key"].alias("key"),
                F.try_variant_get(g["value"], "$.total.total", "double").alias("value")))))
    return (
        records.filter(F.col("name") != bag_stats.ERRORS_BY_GROUP)
        .select(F.inline(F.when(is_profile, profile).otherwise(plain)))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "key").agg(F.sum("value").alias("value"))
    )


def compare_totals(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(name, key, value_left, value_right, diff, diff_percent)``; values cut to whole numbers."""
    r = right.select(F.col("name").alias("_name"), F.col("key").alias("_key"),
                     F.col("value").alias("_value"))
    joined = left.join(r, (F.col("name") == F.col("_name")) & F.col("key").eqNullSafe(F.col("_key")),
                       "full_outer")
    # rounded first, so the order of summation cannot move a value across a whole number
    whole = lambda c: F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).cast("bigint")
    return joined.select(
        F.coalesce("name", "_name").alias("name"), F.coalesce("key", "_key").alias("key"),
        whole("value").alias("value_left"), whole("_value").alias("value_right"),
    ).withColumn("diff", F.col("value_left") - F.col("value_right")).withColumn(
        "diff_percent", text.percent_difference(F.col("value_left"), F.col("value_right")))


def worst_last(compared: DataFrame) -> DataFrame:
    """Ordered by percent difference, undefined ones last."""
    return compared.orderBy(F.col("diff_percent").asc_nulls_last(), "name", "key")
