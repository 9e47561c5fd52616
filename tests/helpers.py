"""Small helpers shared by the tests."""

from __future__ import annotations

import os
from collections import Counter

from pyspark.sql import functions as F


def rows(df, *columns):
    """Rows as a multiset of tuples."""
    picked = df.select(*columns) if columns else df
    return Counter(tuple(r) for r in picked.collect())


def write_topic(raw, folder, parts, by="seq"):
    """Write a topic as ``parts`` JSON files whose modification times follow ``by``."""
    cuts = [i / parts for i in range(1, parts)]
    bounds = raw.approxQuantile(by, cuts, 0.0) if cuts else []
    edges = [float("-inf"), *bounds, float("inf")]
    for i in range(parts):
        part = raw.filter((F.col(by) > edges[i]) & (F.col(by) <= edges[i + 1])).select(
            "seq", "record_ts", "value")
        target = f"{folder}/part-{i}"
        part.coalesce(1).write.json(target)
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return f"{folder}/*"


def run_available(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def memory(df, name, checkpoint, mode="append"):
    """Run a stream to its end into a folder of Parquet files and return its rows."""
    out = f"{checkpoint}/{name}"
    run_available(
        df.writeStream.outputMode(mode).format("parquet").option("path", out)
        .option("checkpointLocation", f"{checkpoint}/{name}-cp"))
    return df.sparkSession.read.schema(df.schema).parquet(out)
