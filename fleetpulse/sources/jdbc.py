"""Relational tables over JDBC. The driver jar, address and credentials are the caller's."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TIME_LITERAL = "%Y-%m-%d %H:%M:%S"


def jdbc_options(
    url: str,
    properties: Mapping[str, str],
    schema: StructType | str | None = None,
    session_init: str | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options; ``session_init`` is run per connection, e.g. to set the session's zone."""
    opts = {"url": url, "fetchsize": str(fetch_rows), "pushDownPredicate": "true",
            **dict(properties)}
    if schema is not None:
        opts["customSchema"] = schema if isinstance(schema, str) else ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if session_init:
        opts["sessionInitStatement"] = session_init
    return opts


def range_query(columns: str, source: str, time: str, start: datetime, end: datetime) -> str:
    """A half-open time range as a table expression, so the filter and join run at the source."""
    a, b = start.strftime(TIME_LITERAL), end.strftime(TIME_LITERAL)
    return (f"(SELECT {columns} FROM {source} "
            f"WHERE {time} >= '{a}' AND {time} < '{b}') t")


def count_query(source: str, where: str = "1 = 1") -> str:
    return f"(SELECT COUNT(*) AS n FROM {source} WHERE {where}) t"


def histogram_query(source: str, time: str, second_expr: str, where: str = "1 = 1") -> str:
    """Rows per second, counted at the source. ``second_expr`` is its way to cut to a second."""
    return (f"(SELECT {second_expr} AS second, COUNT(*) AS n FROM {source} "
            f"WHERE {time} IS NOT NULL AND {where} GROUP BY {second_expr}) t")


def table(spark: SparkSession, options: Mapping[str, str], name_or_query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("dbtable", name_or_query).load()


def bounds_query(source: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS lower, MAX({column}) AS upper FROM {source}) t"


def split_table(
    spark: SparkSession, options: Mapping[str, str], name_or_query: str,
    column: str, lower: str, upper: str, partitions: int,
) -> DataFrame:
    """Whole table in equal parts of one column, read in parallel.

    Rows with a null there, or beyond the bounds, are in the first and last parts.
    """
    return (
        spark.read.format("jdbc").options(**options).option("dbtable", name_or_query)
        .option("partitionColumn", column).option("lowerBound", lower)
        .option("upperBound", upper).option("numPartitions", partitions).load()
    )


def range_predicates(plan: list, time: str, page_expr: str | None = None) -> list[str]:
    """One predicate per task from the rows of a range plan.

    ``page_expr`` is a stable hash of the key in the source's SQL with ``{pages}`` in it; it splits
    a single second that is over the limit without unordered paging.
    """
    out = []
    for r in plan:
        a, b = r["range_start"].strftime(TIME_LITERAL), r["range_end"].strftime(TIME_LITERAL)
        base = f"{time} >= '{a}' AND {time} < '{b}'"
        if r["pages"] > 1 and page_expr:
            part = page_expr.format(pages=r["pages"])
            out += [f"{base} AND {part} = {i}" for i in range(r["pages"])]
        else:
            out.append(base)
    return out


def ranged_table(
    spark: SparkSession, url: str, name_or_query: str, properties: Mapping[str, str],
    predicates: list[str],
) -> DataFrame:
    """One task per predicate; a lost task re-reads only its own range."""
    options = {k: v for k, v in jdbc_options(url, properties).items() if k != "url"}
    return spark.read.jdbc(url, name_or_query, predicates=predicates, properties=options)


def count_rows(spark: SparkSession, options: Mapping[str, str], query: str) -> int:
    return int(table(spark, options, query).select(F.col("n").cast("bigint")).first()[0])
