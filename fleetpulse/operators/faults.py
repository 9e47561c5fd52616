"""Fault sessions per machine and fault type: first fault opens, first health afterwards closes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import text, times
from fleetpulse.operators.runs import order_chunk, status_runs

# Message levels.
FAULT, HEALTH = "fault", "health"
KEYS = ["cluster_name", "node_name", "fault_type"]


def route(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(fault and health messages, messages of any other level)."""
    known = F.coalesce(F.col("msg_level").isin(FAULT, HEALTH), F.lit(False))
    return messages.filter(known), messages.filter(~known)


def levels(messages: DataFrame) -> DataFrame:
    """Each message with the route it takes: fault, health or unknown."""
    return messages.withColumn(
        "route", F.when(F.col("msg_level").isin(FAULT, HEALTH), F.col("msg_level"))
        .otherwise("unknown"))


def whole_minutes(seconds: Column) -> Column:
    """Minutes cut toward zero."""
    return (seconds / 60).cast("bigint")


def fault_sessions(
    messages: DataFrame, order: list[str] | None = None, chunk: Column | None = None
) -> DataFrame:
    """One row per fault: ``start``/``end`` in epoch seconds, ``minutes``; open faults have nulls.

    Repeated faults and health reports without an open fault change nothing. ``order`` is the
    arrival order (default ``seq``).
    """
    order = order or ["seq"]
    if chunk is None:
        chunk = order_chunk(messages, order)
    known, _ = route(messages)
    slim = known.select(*KEYS, *order, "msg_level", "timestamp")
    runs = status_runs(slim, KEYS, order, "msg_level", ["timestamp", *order], chunk)
    end = F.col("nxt.timestamp")
    return runs.filter(F.col("msg_level") == FAULT).select(
        *KEYS, F.col(order[-1]).alias("open_seq"), F.col(f"nxt.{order[-1]}").alias("close_seq"),
        F.col("timestamp").alias("start_time"), end.alias("end_time"),
        whole_minutes(end - F.col("timestamp")).alias("minutes"),
    )


def alerts(sessions: DataFrame) -> DataFrame:
    """Alert records: one when a fault opens, one when it closes."""
    def at(name):
        return times.to_text(times.from_epoch_seconds(F.col(name)))

    who = [F.col("fault_type"), F.col("node_name"), F.col("cluster_name")]
    opened = F.struct(
        F.lit("fault").alias("level"), F.col("start_time").alias("time"),
        F.col("open_seq").alias("seq"),
        text.fault_text(*who, at("start_time")).alias("info"))
    closed = F.struct(
        F.lit("recovery").alias("level"), F.col("end_time").alias("time"),
        F.col("close_seq").alias("seq"),
        text.recovery_text(*who, at("end_time"), F.col("minutes")).alias("info"))
    both = F.array_compact(F.array(opened, F.when(F.col("end_time").isNotNull(), closed)))
    return sessions.select(*KEYS, "minutes", F.inline(both)).select(
        *KEYS, "level", "time", "seq",
        F.when(F.col("level") == "recovery", F.col("minutes")).alias("minutes"), "info")
