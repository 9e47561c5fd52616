"""Rows as JSON text to a topic, files or the console."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def to_json_rows(df: DataFrame) -> DataFrame:
    """One ``value`` text per row; null fields are written."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def stream_json(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: Mapping[str, str] | None = None,
) -> DataStreamWriter:
    """A started-by-caller writer to Kafka (options given) or text files."""
    writer = to_json_rows(df).writeStream.outputMode("append").option(
        "checkpointLocation", checkpoint)
    if kafka is not None:
        return writer.format("kafka").options(**kafka)
    if path is None:
        raise ValueError("give a path or Kafka options")
    return writer.format("text").option("path", path)


def stream_console(df: DataFrame, checkpoint: str, mode: str = "append") -> DataStreamWriter:
    return (df.writeStream.format("console").outputMode(mode)
            .option("checkpointLocation", checkpoint).option("truncate", "false"))
