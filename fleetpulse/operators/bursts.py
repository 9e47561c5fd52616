"""Failure bursts per node: sliding-window counts, alert cooldown, once-only actions.

Rows are first counted in panes as wide as the slide, so the 30-fold window expansion works on at
most one row per node and pane, however many rows a hot node has.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from fleetpulse.functions import text, times

# Window, slide and cooldown in seconds, threshold, accepted status, kind, parts.
WINDOW, SLIDE, COOLDOWN = 300, 10, 300
THRESHOLD = 5
DONE = "successed"
KIND = "replay"
WORKFLOW_PART, KIND_PART = 3, 4
RAISED_PRIORITY = 3
# The words of a window's result.
ALERT_WORDS, COOLING_WORDS, NORMAL_WORDS = "alert: ", "cooling, last: ", "normal: "

DAY = 86_400


def failed_replays(jobs: DataFrame) -> DataFrame:
    """Replay jobs that did not succeed: ``(node_name, ts, workflow)``."""
    kind = text.name_part(F.col("job_name"), KIND_PART)
    failed = ~F.col("job_status").eqNullSafe(F.lit(DONE))
    return jobs.filter(failed & (kind == KIND)).select(
        "node_name",
        times.from_epoch_millis_text(F.col("timestamp")).cast("timestamp_ntz").alias("ts"),
        text.name_part(F.col("job_name"), WORKFLOW_PART).alias("workflow"),
    )


def pane_start(ts: str, slide: int = SLIDE):
    return F.window(ts, f"{slide} seconds")["start"]


def over_windows(panes: DataFrame, size: int = WINDOW, slide: int = SLIDE) -> DataFrame:
    """Repeat each pane row once per sliding window that covers it."""
    if size % slide:
        raise ValueError("the window size must be a multiple of the slide")
    steps = F.explode(F.sequence(F.lit(0), F.lit(size // slide - 1)))
    back = F.make_dt_interval(secs=(F.col("_step") * slide).cast("decimal(18,6)"))
    return (panes.withColumn("_step", steps)
            .withColumn("window_start", F.col("pane") - back).drop("_step", "pane"))


def burst_windows(failures: DataFrame, size: int = WINDOW, slide: int = SLIDE) -> DataFrame:
    """``(node_name, window_start, n, first_ts, last_ts)`` of every non-empty sliding window."""
    panes = failures.groupBy("node_name", pane_start("ts", slide).alias("pane")).agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return over_windows(panes, size, slide).groupBy("node_name", "window_start").agg(
        F.sum("n").alias("n"), F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"))


@F.pandas_udf(ArrayType(DoubleType()))
def _exit_times(first: pd.Series, last: pd.Series, cooldown: pd.Series) -> pd.Series:
    """Per window: the last alert time at the end of the block if that window alerts."""
    out = []
    for f, l, c in zip(first, last, cooldown):
        f, l = np.asarray(f), np.asarray(l)
        at = np.arange(len(f))
        jump = np.searchsorted(f, l + c, side="right")
        jump = np.where(jump < len(f), jump, at)
        while not np.array_equal(jump, jump[jump]):
            jump = jump[jump]
        out.append(l[jump])
    return pd.Series(out)


@F.pandas_udf(ArrayType(DoubleType()))
def _last_alerts(
    first: pd.Series, last: pd.Series, entry: pd.Series, cooldown: pd.Series
) -> pd.Series:
    """Per window: the last alert time after it, given the one on entry (NaN for none)."""
    out = []
    for f, l, s, c in zip(first, last, entry, cooldown):
        f, l = np.asarray(f), np.asarray(l)
        seen = np.full(len(f), np.nan if s is None else s)
        i = 0 if np.isnan(seen[0]) else int(np.searchsorted(f, seen[0] + c, side="right"))
        while i < len(f):
            seen[i:] = l[i]
            i = int(np.searchsorted(f, l[i] + c, side="right"))
        out.append(seen)
    return pd.Series(out)


def burst_alerts(
    windows: DataFrame,
    threshold: int = THRESHOLD,
    cooldown: int = COOLDOWN,
    size: int = WINDOW,
    block: int = DAY,
) -> DataFrame:
    """Windows at or over the threshold with ``outcome`` (alert/cooling) and ``last_alert``.

    A window alerts unless its first element is within the cooldown of the last alert; the last
    alert is then the time of the window's last element. The rule is sequential per node, so time
    is cut into blocks: (1) each block tells, for every window that could be its first to alert,
    which alert it would end with; (2) these short tables are chained per node; (3) each block is
    replayed from its known entry. No task holds more of a node than one block of windows.
    """
    hot = windows.filter(F.col("n") >= threshold).withColumn(
        "block", F.floor(times.epoch_seconds(F.col("window_start")) / block))
    item = F.struct(
        "window_start",
        times.epoch_seconds(F.col("first_ts")).alias("f"),
        times.epoch_seconds(F.col("last_ts")).alias("l"), "n", "first_ts", "last_ts")
    wait = F.lit(float(cooldown))
    blocks = hot.groupBy("node_name", "block").agg(
        F.array_sort(F.collect_list(item)).alias("w"))

    # Earlier blocks end their alerts before block start + size, so the first window to alert here
    # is one of those up to the first beyond that time plus the cooldown.
    bound = F.col("block") * block + size + cooldown
    reach = F.size(F.filter("w", lambda x: x["f"] <= bound)) + 1
    tables = (
        blocks.withColumn("exits", _exit_times(F.col("w.f"), F.col("w.l"), wait))
        .select("node_name", "block",
                F.slice(F.arrays_zip(F.col("w.f").alias("f"), F.col("exits").alias("out")),
                        F.lit(1), reach).alias("starts"))
    )
    begin = F.struct(
        F.lit(None).cast("double").alias("now"),
        F.array().cast("array<struct<block:bigint,entry:double>>").alias("entries"))

    def step(acc, b):
        choices = F.filter(
            b["starts"], lambda x: acc["now"].isNull() | (x["f"] > acc["now"] + wait))
        return F.struct(
            F.coalesce(F.get(choices, F.lit(0))["out"], acc["now"]).alias("now"),
            F.concat(acc["entries"], F.array(F.struct(
                b["block"].alias("block"), acc["now"].alias("entry")))).alias("entries"))

    entries = (
        tables.groupBy("node_name")
        .agg(F.array_sort(F.collect_list(F.struct("block", "starts"))).alias("chain"))
        .select(F.col("node_name").alias("_node"),
                F.inline(F.aggregate("chain", begin, step)["entries"]))
        .withColumnRenamed("block", "_block")
    )
    replayed = blocks.join(
        # null-safe on both: no filter is inferred for one side, so both read the same blocks
        entries, F.col("node_name").eqNullSafe(F.col("_node"))
        & F.col("block").eqNullSafe(F.col("_block")), "inner",
    ).withColumn("seen", _last_alerts(F.col("w.f"), F.col("w.l"), F.col("entry"), wait))
    # an alert moves the last alert forward, a cooling window leaves it
    before = F.concat(F.array("entry"), F.slice("seen", F.lit(1), F.size("seen") - 1))
    rows = replayed.withColumn("before", before).select(
        "node_name", F.inline(F.arrays_zip("w", "seen", "before")))
    seen_ts = F.timestamp_micros(F.round(F.col("seen") * 1e6).cast("bigint"))
    fresh = F.col("before").isNull() | (F.col("before") < F.col("seen"))
    return rows.select(
        "node_name", F.col("w.window_start").alias("window_start"), F.col("w.n").alias("n"),
        F.col("w.first_ts").alias("first_ts"), F.col("w.last_ts").alias("last_ts"),
        seen_ts.cast("timestamp_ntz").alias("last_alert"),
        F.when(fresh, "alert").otherwise("cooling").alias("outcome"),
    )


def outcome_text(outcome, n, last_alert):
    """The one-line result of a window."""
    at = times.to_text(last_alert)
    return (
        F.when(outcome == "alert", F.concat(F.lit(ALERT_WORDS), at))
        .when(outcome == "cooling", F.concat(F.lit(COOLING_WORDS), at))
        .otherwise(F.concat(F.lit(NORMAL_WORDS), n.cast("string")))
    )


def window_results(windows: DataFrame, alerts: DataFrame) -> DataFrame:
    """Every window with its outcome: normal, cooling or alert."""
    decided = alerts.select(F.col("node_name").alias("_node"), F.col("window_start").alias("_ws"),
                            "last_alert", "outcome")
    joined = windows.join(
        decided, F.col("node_name").eqNullSafe(F.col("_node"))
        & F.col("window_start").eqNullSafe(F.col("_ws")), "left")
    return joined.select(
        "node_name", "window_start", "n", "last_alert",
        F.coalesce("outcome", F.lit("normal")).alias("outcome"),
    ).withColumn("result", outcome_text(F.col("outcome"), F.col("n"), F.col("last_alert")))


def _periods(alerts: DataFrame, clear_after: bool) -> DataFrame:
    by_time = Window.partitionBy("node_name").orderBy("window_start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    is_alert = (F.col("outcome") == "alert").cast("int")
    upto = F.sum(is_alert).over(by_time)
    period = upto if not clear_after else F.greatest(upto - is_alert - 1, F.lit(0))
    return alerts.select("node_name", "window_start", period.alias("period"))


def burst_actions(
    failures: DataFrame,
    alerts: DataFrame,
    size: int = WINDOW,
    slide: int = SLIDE,
    clear_after: bool = False,
) -> DataFrame:
    """Actions ``(node_name, window_start, kind, target)``: cordon the node, raise a workflow.

    Each is taken once per cooldown period, at the first window that calls for it. A new period
    starts with an alert; with ``clear_after`` the memory is cleared only after the alerting
    window itself was handled, so the next window acts again.
    """
    # per pane and period: the first burst window of the period that covers the pane
    step = F.explode(F.sequence(F.lit(0), F.lit(size // slide - 1)))
    ahead = F.make_dt_interval(secs=(F.col("_step") * slide).cast("decimal(18,6)"))
    covered = (
        _periods(alerts, clear_after).withColumn("_step", step)
        .groupBy("node_name", (F.col("window_start") + ahead).alias("pane"), "period")
        .agg(F.min("window_start").alias("window_start"))
    )
    present = failures.select(
        F.col("node_name").alias("_node"), pane_start("ts", slide).alias("_pane"),
        "workflow").distinct()
    first_seen = (
        covered.join(present, F.col("node_name").eqNullSafe(F.col("_node"))
                     & (F.col("pane") == F.col("_pane")))
        .groupBy("node_name", "period", "workflow")
        .agg(F.min("window_start").alias("window_start"))
    )
    # every burst window holds a workflow, so the period's first window is among these
    cordon = first_seen.groupBy("node_name", "period").agg(
        F.min("window_start").alias("window_start"))
    raised = first_seen.select("node_name", "window_start", F.lit("raise_priority").alias("kind"),
                               F.col("workflow").alias("target"))
    return raised.unionByName(cordon.select(
        "node_name", "window_start", F.lit("cordon").alias("kind"),
        F.col("node_name").alias("target")))


def action_records(actions: DataFrame) -> DataFrame:
    """One record per node, window and kind, with the list of targets."""
    return actions.groupBy("node_name", "window_start", "kind").agg(
        F.array_sort(F.collect_list("target")).alias("targets"))


def alert_records(alerts: DataFrame) -> DataFrame:
    """Alert rows with a level, a time and a text; windows in the cooldown have none."""
    def at(name: str):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss")

    info = F.concat(
        F.lit("node "), "node_name", F.lit(": "), F.col("n").cast("string"),
        F.lit(" failed replays from "), at("first_ts"), F.lit(" to "), at("last_ts"))
    return alerts.withColumns({
        "level": F.when(F.col("outcome") == "alert", "burst"),
        "time": F.when(F.col("outcome") == "alert", F.col("last_ts")),
        "info": F.when(F.col("outcome") == "alert", info)})
