"""Bounded range plans, child-row selection, paging, incremental copy and retention."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

# Rows per range, slice of one plan, lag of the daily copy, retention, in days.
RANGE_ROWS = 5000
SLICE = "hour"
COPY_LAG_DAYS = 30
KEEP_DAYS = 90


def in_range(c: Column, start, end) -> Column:
    """Half-open: start <= c < end."""
    return (c >= F.lit(start)) & (c < F.lit(end))


def children_of(children: DataFrame, parents: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child columns of the inner join (a child repeats if its parent key does)."""
    ids = parents.select(F.col(pk).alias("_pk"))
    return children.join(ids, F.col(fk) == F.col("_pk"), "inner").drop("_pk")


def children_in(children: DataFrame, ids: DataFrame, fk: str, pk: str) -> DataFrame:
    """Children whose parent is in ``ids``; one semi join instead of batches of id lists."""
    return children.join(
        ids.select(F.col(pk).alias("_pk")), F.col(fk) == F.col("_pk"), "left_semi")


def day_bounds(as_of: date, lag_days: int) -> tuple[datetime, datetime]:
    """The one whole day that ends ``lag_days`` before ``as_of``."""
    end = datetime(as_of.year, as_of.month, as_of.day) - timedelta(days=lag_days)
    return end - timedelta(days=1), end


def incremental(
    parents: DataFrame, children: DataFrame, as_of: date, lag_days: int = COPY_LAG_DAYS,
    pk: str = "workflow_id", fk: str = "workflow_id_id", time: str = "create_time",
) -> tuple[DataFrame, DataFrame]:
    """One day's parents and their children."""
    start, end = day_bounds(as_of, lag_days)
    chosen = parents.filter(in_range(F.col(time), start, end))
    return chosen, children_in(children, chosen, fk, pk)


def retained(
    parents: DataFrame, children: DataFrame, start, end,
    pk: str = "workflow_id", fk: str = "workflow_id_id", time: str = "create_time",
) -> tuple[DataFrame, DataFrame]:
    """(parents, children) left after deleting the parents of [start, end) and their children."""
    gone = in_range(F.col(time), start, end)
    expired = parents.filter(gone).select(F.col(pk).alias("_pk"))
    keep = parents.filter(~F.coalesce(gone, F.lit(False)))
    return keep, children.join(expired, F.col(fk) == F.col("_pk"), "left_anti")


def retention_bounds(as_of: date, keep_days: int = KEEP_DAYS) -> tuple[datetime, datetime]:
    return day_bounds(as_of, keep_days)


def histogram(df: DataFrame, time: str) -> DataFrame:
    """Rows per second."""
    return df.groupBy(F.date_trunc("second", F.col(time)).cast("timestamp_ntz").alias("second")).agg(
        F.count("*").alias("n")).filter(F.col("second").isNotNull())


def labelled_seconds(per_second: DataFrame, rows: int = RANGE_ROWS,
                     slice: str = SLICE) -> DataFrame:
    """Every second with the range it is in: ``(second, n, range_start, range_end, range_n, pages)``.

    A range lies in one slice and holds at most ``rows`` rows, or is a single second; a single
    second over the limit gets ``pages`` > 1. Running sums stay inside a slice, so no task sees
    more than one slice of seconds.
    """
    part = F.date_trunc(slice, F.col("second")).cast("timestamp_ntz")
    along = Window.partitionBy("slice").orderBy("second").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    first_bin = F.floor((F.col("upto") - F.col("n")) / rows)
    last_bin = F.floor((F.col("upto") - 1) / rows)
    whole = Window.partitionBy("slice", "bin", "own")
    # a second whose rows straddle two bins is a range of its own
    return (
        per_second.withColumn("slice", part).withColumn("upto", F.sum("n").over(along))
        .withColumn("own", F.when(first_bin != last_bin, F.col("second")))
        .withColumn("bin", first_bin)
        .select("second", "n", F.min("second").over(whole).alias("range_start"),
                (F.max("second").over(whole) + F.expr("INTERVAL 1 SECOND")).alias("range_end"),
                F.sum("n").over(whole).alias("range_n"))
        .withColumn("pages", F.ceil(F.col("range_n") / rows))
    )


def range_plan(per_second: DataFrame, rows: int = RANGE_ROWS, slice: str = SLICE) -> DataFrame:
    """Disjoint ranges that cover every second with rows: ``(range_start, range_end, n, pages)``."""
    return labelled_seconds(per_second, rows, slice).filter("second = range_start").select(
        "range_start", "range_end", F.col("range_n").alias("n"), "pages")


def page_of(keys: list[str], pages: Column) -> Column:
    """A stable page number for a row of an oversized range; any SQL source can work it out too."""
    digest = F.md5(F.concat_ws("|", *keys).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), pages)


def assign_ranges(df: DataFrame, seconds: DataFrame, time: str, keys: list[str]) -> DataFrame:
    """Rows with the start of their range and their page; rows without a time have neither.

    ``seconds`` is a :func:`labelled_seconds`: an equi join on the second, one match a row.
    """
    known = seconds.select(F.col("second").alias("_second"), "range_start", "pages")
    second = F.date_trunc("second", F.col(time)).cast("timestamp_ntz")
    return (df.join(known, second == F.col("_second"), "left")
            .withColumn("page", page_of(keys, F.col("pages"))).drop("_second", "pages"))


def page(df: DataFrame, order: list[str], limit: int, offset: int) -> DataFrame:
    """One page of rows; ``order`` must be total."""
    return df.orderBy(*order).offset(offset).limit(limit)


def _any_value(kind: DataType) -> Column:
    """A value of a type that is not null."""
    if isinstance(kind, ArrayType):
        return F.array().cast(kind)
    if isinstance(kind, MapType):
        return F.map_from_arrays(F.array().cast(ArrayType(kind.keyType)),
                                 F.array().cast(ArrayType(kind.valueType)))
    if isinstance(kind, StructType):
        return F.struct(*((F.lit(None).cast(f.dataType) if f.nullable else _any_value(f.dataType))
                          .alias(f.name) for f in kind.fields))
    name = kind.typeName()
    if "timestamp" in name:
        return F.lit(datetime(1970, 1, 1)).cast(kind)
    if name == "date":
        return F.lit(date(1970, 1, 1))
    if name == "decimal":
        return F.lit(Decimal(0)).cast(kind)
    if name == "binary":
        return F.lit("").cast(kind)
    return F.lit(0).cast(kind)


def require_not_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Declare columns of any type non-nullable; a null in one of them fails the job.

    The check and the declaration are one expression: the constant behind it is never reached.
    """
    def checked(c):
        kind = df.schema[c].dataType
        fail = F.raise_error(F.lit(f"null in {c}")).cast(kind)
        return F.coalesce(F.when(F.col(c).isNull(), fail).otherwise(F.col(c)), _any_value(kind))

    return df.withColumns({c: checked(c) for c in columns})
