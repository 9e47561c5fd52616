"""Lake tables: a catalog table by name, or a Parquet folder by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetpulse.sources.keyed import is_keyed, keyed_rows


def is_path(name: str) -> bool:
    return "/" in name


def lake_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table; of a keyed folder, those of its newest version."""
    if not is_path(name):
        return spark.table(name)
    return keyed_rows(spark, name) if is_keyed(spark, name) else spark.read.parquet(name)
