"""Daily workflow statistics: nine metrics from workflow messages.

A SUCCESS/FAILURE message is *accepted* when its status differs from the last accepted one of the
same workflow and day. An accepted message adds to its counters; when the workflow later changes
status that day, the by-type count of the earlier message is taken back.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import nested, payload, times
from fleetpulse.operators.days import open_days
from fleetpulse.operators.runs import order_chunk, status_runs

# Statistic names, statuses and types.
SUCCESS_PODS = "stat_success_pod_group_by_type"
FAILURE_PODS = "stat_failure_pod_group_by_type"
REPLAY_OK_BY_CATEGORY = "stat_replay_success_bag_group_by_category"
REPLAY_BAD_BY_CATEGORY = "stat_replay_failure_bag_group_by_category"
REPLAY_OK_BY_MODE = "stat_replay_success_bag_group_by_mode"
REPLAY_BAD_BY_MODE = "stat_replay_failure_bag_group_by_mode"
OK_BAGS_BY_TYPE = "stat_success_bag_group_by_type"
BAD_BAGS_BY_TYPE = "stat_failure_bag_group_by_type"
TIME_CONSUMING = "stat_replay_time_consuming_group_by_category"
DECIDED = ("SUCCESS", "FAILURE")
REPLAY = "replay"
PROBE = "probe_detect"

COUNTERS = (
    SUCCESS_PODS, FAILURE_PODS, REPLAY_OK_BY_CATEGORY, REPLAY_BAD_BY_CATEGORY, REPLAY_OK_BY_MODE,
    REPLAY_BAD_BY_MODE, OK_BAGS_BY_TYPE, BAD_BAGS_BY_TYPE,
)
ALL_METRICS = (*COUNTERS, TIME_CONSUMING)

KEYS = ["stat_date", "workflow_id"]


def reshape(messages: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Decoded messages (plus ``seq``, their arrival order) to the columns the metrics need."""
    bags = payload.bag_list(F.col("workflow_output"))
    read = messages.withColumns({
        "_updated": times.parse_text(F.col("update_time")), "_bags": payload.count_bags(bags)})
    return read.select(
        "seq", *(extra or []),
        F.col("_updated").alias("ts"),
        F.to_date("_updated").alias("stat_date"),
        "workflow_id", "workflow_type", "category", "device", "workflow_status",
        F.col("bag_nums").cast("bigint").alias("bag_nums"),
        F.upper(payload.mode_of(F.col("workflow_input"))).alias("mode"),
        F.col("_bags.n_ok").alias("n_ok"),
        F.col("_bags.n_bad").alias("n_bad"),
        payload.profile_of(F.col("metric")).alias("profile"),
    ).filter(F.col("stat_date").isNotNull())


def _is_decided() -> Column:
    return F.coalesce(F.col("workflow_status").isin(*DECIDED), F.lit(False))


def accepted_events(
    events: DataFrame,
    order: list[str] | None = None,
    chunk: Column | None = None,
    late_dedupe: bool = True,
    with_undecided: bool = False,
) -> DataFrame:
    """Accepted SUCCESS/FAILURE events with ``nxt.seq``, the event that took them back (or null).

    With ``late_dedupe=False`` (needs ``is_today`` from :func:`open_days`) records that arrive for
    yesterday are all accepted and neither compared nor taken back. ``with_undecided`` also keeps
    replay events of other statuses (their profiles count). Rows that are not compared are keys of
    their own, so everything comes from one pass over the messages.
    """
    order = order or ["seq"]
    if chunk is None:
        chunk = order_chunk(events, order)
    compared = _is_decided()
    if with_undecided:
        wanted = _is_decided() | (F.col("workflow_type") == REPLAY)
    else:
        wanted = _is_decided()
    if not late_dedupe:
        compared = compared & F.col("is_today")
    rows = events.filter(wanted)
    if not with_undecided and late_dedupe:
        return status_runs(rows, KEYS, order, "workflow_status", ["seq"], chunk)
    alone = rows.withColumn("_alone", F.when(~compared, F.col("seq")))
    return status_runs(
        alone, [*KEYS, "_alone"], order, "workflow_status", ["seq"], chunk).drop("_alone")


def transitions(accepted: DataFrame) -> DataFrame:
    """Rows of change: +1 for an accepted event, and -1 at the event that takes it back."""
    gone = F.col("nxt").isNotNull()
    entries = F.array_compact(F.array(
        F.struct(F.col("seq").alias("at_seq"), F.lit(1).alias("sign")),
        F.when(gone, F.struct(F.col("nxt.seq").alias("at_seq"), F.lit(-1).alias("sign"))),
    ))
    return (
        accepted.withColumn("_e", F.explode(entries))
        .select("stat_date", "workflow_id", F.col("_e.at_seq").alias("seq"),
                F.col("_e.sign").alias("sign"), "workflow_status", "workflow_type", "category")
    )


def _entry(when: Column, name: Column | str, key: Column, value: Column) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return F.when(when & value.isNotNull(), F.struct(
        label.alias("name"),
        F.array(F.coalesce(key, F.lit("null"))).alias("path"),
        value.cast("double").alias("value")))


def counter_entries(
    accepted: DataFrame, metrics: tuple[str, ...], retract_key: str
) -> list[Column]:
    """Per accepted row: what it adds to (or takes back from) each chosen counter, or null."""
    if retract_key not in ("type", "category"):
        raise ValueError("retract_key must be 'type' or 'category'")
    cols = set(accepted.columns)
    add = F.col("sign") == 1 if "sign" in cols else F.lit(True)
    take_back = F.col("nxt").isNotNull() if "nxt" in cols else F.col("sign") == -1
    ok = F.col("workflow_status") == "SUCCESS"
    bad = F.col("workflow_status") == "FAILURE"
    typ, cat, mode = F.col("workflow_type"), F.col("category"), F.col("mode")
    is_replay = F.coalesce(typ == REPLAY, F.lit(False))
    no_probe = ~typ.eqNullSafe(F.lit(PROBE))
    good_bags = F.when(ok & (F.col("n_ok") > 0), F.col("n_ok"))
    bad_bags = F.when(ok & (F.col("n_bad") > 0), F.col("n_bad")).when(bad, F.col("bag_nums"))
    back_key = typ if retract_key == "type" else cat

    candidates = {
        SUCCESS_PODS: [
            _entry(add & ok, SUCCESS_PODS, typ, F.lit(1)),
            _entry(take_back & ok, SUCCESS_PODS, back_key, F.lit(-1)),
        ],
        FAILURE_PODS: [
            _entry(add & bad, FAILURE_PODS, typ, F.lit(1)),
            _entry(take_back & bad, FAILURE_PODS, back_key, F.lit(-1)),
        ],
        REPLAY_OK_BY_CATEGORY: [_entry(add & is_replay, REPLAY_OK_BY_CATEGORY, cat, good_bags)],
        REPLAY_BAD_BY_CATEGORY: [_entry(add & is_replay, REPLAY_BAD_BY_CATEGORY, cat, bad_bags)],
        REPLAY_OK_BY_MODE: [
            _entry(add & is_replay & mode.isNotNull(), REPLAY_OK_BY_MODE, mode, good_bags)],
        REPLAY_BAD_BY_MODE: [
            _entry(add & is_replay & mode.isNotNull(), REPLAY_BAD_BY_MODE, mode, bad_bags)],
        OK_BAGS_BY_TYPE: [_entry(add & no_probe, OK_BAGS_BY_TYPE, typ, good_bags)],
        BAD_BAGS_BY_TYPE: [_entry(add & no_probe, BAD_BAGS_BY_TYPE, typ, bad_bags)],
    }
    return [e for m in metrics if m in candidates for e in candidates[m]]


def counter_deltas(
    accepted: DataFrame, metrics: tuple[str, ...] = COUNTERS, retract_key: str = "type"
) -> DataFrame:
    """Long rows ``(seq, stat_date, name, path, value)`` for the eight counters.

    ``retract_key='category'`` takes a status change back under the category instead of the type.
    A stream hands in take-backs as rows of their own, marked by ``sign = -1``.
    """
    entries = counter_entries(accepted, metrics, retract_key)
    return accepted.select("seq", "stat_date", F.inline(F.array_compact(F.array(*entries))))


def long_rows(
    accepted: DataFrame,
    metrics: tuple[str, ...] = ALL_METRICS,
    retract_key: str = "type",
) -> DataFrame:
    """All chosen metrics as node rows ``(seq, stat_date, name, device, category, path, kind,
    value, text)``; device and category are set for profile nodes only."""
    lone = F.lit(None).cast("string")
    entries = F.transform(
        F.array_compact(F.array(*counter_entries(accepted, metrics, retract_key))),
        lambda e: F.struct(
            e["name"].alias("name"), lone.alias("device"), lone.alias("category"),
            e["path"].alias("path"), F.lit("number").alias("kind"), e["value"].alias("value"),
            lone.alias("text")))
    profile = F.when(F.col("workflow_type") == REPLAY, F.col("profile"))
    profiles = F.transform(nested.nodes(profile), lambda x: F.struct(
        F.lit(TIME_CONSUMING).alias("name"),
        F.coalesce("device", F.lit("null")).alias("device"),
        F.coalesce("category", F.lit("null")).alias("category"),
        x["path"].alias("path"), x["kind"].alias("kind"), x["value"].alias("value"),
        x["text"].alias("text")))
    if TIME_CONSUMING not in metrics:
        body = entries
    elif len(metrics) == 1:
        body = profiles
    else:
        body = F.concat(entries, profiles)
    return accepted.select("seq", "stat_date", F.inline(body))


def statistics(
    events: DataFrame,
    metrics: tuple[str, ...] = ALL_METRICS,
    order: list[str] | None = None,
    chunk: Column | None = None,
    retract_key: str = "type",
    late_dedupe: bool = True,
    as_of: date | None = None,
    drop_late: bool = False,
    prev_seen_day: bool = False,
    clashes: str = "resolve",
) -> DataFrame:
    """``(stat_date, name, path, value)`` for the chosen metrics.

    ``drop_late`` applies the open-day rule by arrival first; ``clashes`` says what to do with
    profiles whose layout changes (see :func:`nested.deep_sum`).
    """
    order = order or ["seq"]
    if drop_late or not late_dedupe:
        events = open_days(events, order, as_of=as_of, prev_seen_day=prev_seen_day)
    with_profiles = TIME_CONSUMING in metrics
    accepted = accepted_events(events, order, chunk, late_dedupe, with_profiles)
    if not with_profiles:
        deltas = counter_deltas(accepted, metrics, retract_key)
        return nested.add_at_path(deltas, ["stat_date", "name"]).select(
            "stat_date", "name", "path", "value")
    keys = ["stat_date", "name", "device", "category"]
    summed = nested.deep_sum(long_rows(accepted, metrics, retract_key), keys, "seq", clashes)
    place = F.when(F.col("name") == TIME_CONSUMING, F.array("device", "category")).otherwise(
        F.array().cast("array<string>"))
    return summed.filter(F.col("value").isNotNull()).select(
        "stat_date", "name", F.concat(place, F.col("path")).alias("path"), "value")


def records(stats: DataFrame, depth: int | None = None) -> DataFrame:
    """One ``(name, 'daily', stat_date, info)`` record per statistic and day.

    ``depth`` is the longest path there is; without it, one pass over the statistics finds out.
    """
    if depth is None:
        depth = stats.agg(F.max(F.size("path"))).first()[0] or 1
    body = nested.nest_to_json(stats, ["name", "stat_date"], depth)
    return body.select(
        "name", F.lit("daily").alias("period"),
        times.to_text(F.col("stat_date").cast("timestamp_ntz")).alias("stat_date"), "info")
