"""Failure bursts as a stream.

Closed panes (one row per node and slide, from a partial aggregate) feed one state per node that
evaluates the sliding windows, the threshold, the cooldown and the once-only actions together.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from fleetpulse.operators import bursts
from fleetpulse.schemas import layout

_PANE = layout("n long, first_us long, last_us long, workflows string")
EVENTS = layout(
    "node_name string, window_ms long, kind string, n long, first_us long, last_us long, "
    "last_alert_us long, target string")
_EVENT = Row(*EVENTS.fieldNames())


def closed_panes(failures: DataFrame, lateness: str, slide: int = bursts.SLIDE) -> DataFrame:
    """Failures per node and pane, once the watermark has passed the pane."""
    timed = failures.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return (
        timed.groupBy(F.window("ts", f"{slide} seconds"), "node_name")
        .agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
             F.collect_set("workflow").alias("workflows"))
        .select(
            F.window_time("window").alias("closed_at"), "node_name",
            F.unix_millis("window.start").alias("pane_ms"), "n",
            F.unix_micros("first_ts").alias("first_us"),
            F.unix_micros("last_ts").alias("last_us"),
            F.to_json("workflows").alias("workflows"))
    )


class BurstState(StatefulProcessor):
    """Windows at or over the threshold, and the actions they call for."""

    def __init__(self, threshold, cooldown, size, slide, clear_after):
        self._threshold, self._cooldown = threshold, cooldown * 1_000_000
        self._size, self._slide = size * 1000, slide * 1000
        self._clear_after = clear_after

    def init(self, handle) -> None:
        self._handle = handle
        self._panes = handle.getMapState("panes", layout("pane_ms long"), _PANE)
        self._done = handle.getValueState("done", layout("end_ms long"))
        self._alert = handle.getValueState("alert", layout("last_us long"))
        self._raised = handle.getMapState("raised", layout("workflow string"), layout("at long"))
        self._cordoned = handle.getValueState("cordoned", layout("at long"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            self._panes.updateValue(
                (r["pane_ms"],), (r["n"], r["first_us"], r["last_us"], r["workflows"]))
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key[0], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _advance(self, node, clock) -> Iterator[Row]:
        """Evaluate every window that ends by the clock and was not evaluated yet.

        The window slides over the panes in order: each pane enters it once and leaves it once, and
        stretches without panes are skipped, so catching up is linear in the panes.
        """
        panes = sorted((k[0], tuple(v)) for k, v in self._panes.iterator())
        if not panes:
            return
        done = self._done.get()[0] if self._done.exists() else 0
        stop = min(clock // self._slide * self._slide, panes[-1][0] + self._size)
        end = max(done, panes[0][0]) + self._slide
        head = tail = n = 0
        present: Counter[str] = Counter()
        while end <= stop:
            begin = end - self._size
            while tail < len(panes) and panes[tail][0] < end:
                n += panes[tail][1][0]
                present.update(json.loads(panes[tail][1][3]))
                tail += 1
            while head < tail and panes[head][0] < begin:
                n -= panes[head][1][0]
                present.subtract(json.loads(panes[head][1][3]))
                head += 1
            if head == tail:
                if tail == len(panes):
                    break
                end = panes[tail][0] + self._slide
                continue
            if n >= self._threshold:
                # panes don't overlap in time: the first and last ones hold the first and last rows
                yield from self._burst(node, begin, n, panes[head][1][1], panes[tail - 1][1][2],
                                       [w for w, c in present.items() if c > 0])
            done, end = end, end + self._slide
        self._done.update((done,))
        left = [p for p, _ in panes if p + self._size > done]
        for p, _ in panes[:len(panes) - len(left)]:
            self._panes.removeKey((p,))
        if left:
            self._handle.registerTimer(max(done, left[0]) + self._slide)

    def _burst(self, node, begin, n, first, last, workflows) -> Iterator[Row]:
        known = self._alert.get()[0] if self._alert.exists() else None
        is_alert = known is None or first - known > self._cooldown
        forget = is_alert and known is not None
        if forget and not self._clear_after:
            self._forget()
        if not self._cordoned.exists():
            self._cordoned.update((begin,))
            yield _EVENT(node, begin, "cordon", n, first, last, None, node)
        for workflow in sorted(workflows):
            if not self._raised.containsKey((workflow,)):
                self._raised.updateValue((workflow,), (begin,))
                yield _EVENT(node, begin, "raise_priority", n, first, last, None, workflow)
        if forget and self._clear_after:
            self._forget()
        if is_alert:
            known = last
            self._alert.update((last,))
        yield _EVENT(node, begin, "alert" if is_alert else "cooling", n, first, last, known, None)

    def _forget(self) -> None:
        self._raised.clear()
        self._cordoned.clear()


class ClockBurstState(BurstState):
    """The same by the clock: a row belongs to the time at which it is read, and a window is judged
    when the clock passes its end, whether or not anything comes after."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        pane = (now // self._slide * self._slide,)
        n, first, workflows = 0, now * 1000, set()
        if self._panes.containsKey(pane):
            n, first, _, known = self._panes.getValue(pane)
            workflows.update(json.loads(known))
        for r in rows:
            n += 1
            if r["workflow"] is not None:
                workflows.add(r["workflow"])
        self._panes.updateValue(pane, (n, first, now * 1000, json.dumps(sorted(workflows))))
        yield from self._advance(key[0], now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key[0], timerValues.getCurrentProcessingTimeInMs())


def burst_events(
    failures: DataFrame,
    lateness: str = "10 seconds",
    threshold: int = bursts.THRESHOLD,
    cooldown: int = bursts.COOLDOWN,
    size: int = bursts.WINDOW,
    slide: int = bursts.SLIDE,
    clear_after: bool = False,
) -> DataFrame:
    """Alert, cooling, cordon and raise_priority rows from a stream of failed replays."""
    processor = BurstState(threshold, cooldown, size, slide, clear_after)
    return closed_panes(failures, lateness, slide).groupBy("node_name").transformWithState(
        processor, EVENTS, "Append", "EventTime")


def burst_events_by_clock(
    failures: DataFrame,
    threshold: int = bursts.THRESHOLD,
    cooldown: int = bursts.COOLDOWN,
    size: int = bursts.WINDOW,
    slide: int = bursts.SLIDE,
    clear_after: bool = False,
) -> DataFrame:
    """The same rows with windows over the time at which failures are read.

    Timers of the state fire by the clock: to be run at an interval, when micro-batches come without
    rows too.
    """
    processor = ClockBurstState(threshold, cooldown, size, slide, clear_after)
    return failures.select("node_name", "workflow").groupBy("node_name").transformWithState(
        processor, EVENTS, "Append", "ProcessingTime")


def _ts(c: str, fn=F.timestamp_micros):
    return fn(F.col(c)).cast("timestamp_ntz")


def alerts(events: DataFrame) -> DataFrame:
    """Columns of the batch operator's alert rows."""
    return events.filter(F.col("kind").isin("alert", "cooling")).select(
        "node_name", _ts("window_ms", F.timestamp_millis).alias("window_start"), "n",
        _ts("first_us").alias("first_ts"), _ts("last_us").alias("last_ts"),
        _ts("last_alert_us").alias("last_alert"), F.col("kind").alias("outcome"))


def actions(events: DataFrame) -> DataFrame:
    return events.filter(F.col("kind").isin("cordon", "raise_priority")).select(
        "node_name", _ts("window_ms", F.timestamp_millis).alias("window_start"), "kind", "target")
