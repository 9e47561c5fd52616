"""Fault sessions as a stream: the start of the open fault per (cluster, node, fault type)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetpulse.functions import text, times
from fleetpulse.operators import faults
from fleetpulse.schemas import layout

_OPEN = layout("start_time double, open_seq long")
EVENTS = layout(
    "cluster_name string, node_name string, fault_type string, level string, time double, "
    "seq long, start_time double, open_seq long")
_EVENT = Row(*EVENTS.fieldNames())


class OpenFaults(StatefulProcessor):
    """One row when a fault opens (``fault``) and one when it closes (``recovery``)."""

    def init(self, handle) -> None:
        self._open = handle.getValueState("open", _OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        current = self._open.get() if self._open.exists() else None
        for row in sorted(rows, key=lambda r: r["seq"]):
            if row["msg_level"] == faults.FAULT and current is None:
                current = (row["timestamp"], row["seq"])
                yield _EVENT(*key, "fault", row["timestamp"], row["seq"], *current)
            elif row["msg_level"] == faults.HEALTH and current is not None:
                yield _EVENT(*key, "recovery", row["timestamp"], row["seq"], *current)
                current = None
        if current is None:
            self._open.clear()
        else:
            self._open.update(tuple(current))

    def close(self) -> None:
        pass


def fault_events(messages: DataFrame) -> DataFrame:
    """Streaming messages to opening and closing rows."""
    known, _ = faults.route(messages)
    return known.select(*faults.KEYS, "seq", "msg_level", "timestamp").groupBy(
        *faults.KEYS).transformWithState(OpenFaults(), EVENTS, "Append", "None")


def alerts(events: DataFrame) -> DataFrame:
    """The same alert records as the batch operator writes."""
    minutes = faults.whole_minutes(F.col("time") - F.col("start_time"))
    at = times.to_text(times.from_epoch_seconds(F.col("time")))
    who = [F.col("fault_type"), F.col("node_name"), F.col("cluster_name")]
    recovered = F.col("level") == "recovery"
    return events.select(
        *faults.KEYS, "level", "time", "seq", F.when(recovered, minutes).alias("minutes"),
        F.when(recovered, text.recovery_text(*who, at, minutes))
        .otherwise(text.fault_text(*who, at)).alias("info"))
