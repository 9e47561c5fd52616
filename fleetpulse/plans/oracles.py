"""The same figures from the raw columns in plain SQL, for an independent engine to run."""

from __future__ import annotations

from fleetpulse.functions.text import LOG_FALLBACK, LOG_MARKERS
from fleetpulse.operators import bag_stats
from fleetpulse.operators import workflow_stats as wf
from fleetpulse.operators.transfer import KEEP_DAYS
from fleetpulse.plans.queries import (
    AS_OF,
    PLAN_ROWS,
    RANGE_END,
    RANGE_START,
    RETAIN_AS_OF,
    SEED_DAY,
    WIDE,
    ZONE,
)

_STATUS = """CASE event_type WHEN 'error' THEN 'FAILURE' WHEN 'purchase' THEN 'SUCCESS'
    WHEN 'signup' THEN 'SUCCESS' WHEN 'click' THEN 'RUNNING' END"""


def _bags(hit: str) -> str:
    one = " + ".join(
        f"(CASE WHEN event_id % 4 > {i} AND (event_id + {i}) % 3 {hit} 0 THEN 1 ELSE 0 END)"
        for i in range(3))
    return f"CASE WHEN event_id % 7 = 0 THEN 0 ELSE {one} END"


_WF = f"""
wf AS (SELECT event_id AS seq, CAST(ts AS DATE) AS stat_date, 'wf-' || user_id AS workflow_id,
    CASE user_id % 3 WHEN 0 THEN 'replay' WHEN 1 THEN 'probe_detect' ELSE 'convert' END AS typ,
    'cat' || (user_id % 4) AS cat, 'dev' || (user_id % 2) AS dev, {_STATUS} AS status,
    event_id % 5 AS bag_nums, CASE WHEN event_id % 5 <> 0 THEN 'M' || (event_id % 4) END AS mode,
    {_bags('<>')} AS n_ok, {_bags('=')} AS n_bad,
    CASE WHEN event_id % 6 <> 0 THEN value END AS profile,
    date_trunc('second', ts) + CASE event_id % 50 WHEN 0 THEN INTERVAL 60 HOUR
        WHEN 1 THEN INTERVAL 20 HOUR ELSE INTERVAL 0 HOUR END AS arrival_s,
    ts + CASE event_id % 50 WHEN 0 THEN INTERVAL 60 HOUR
        WHEN 1 THEN INTERVAL 20 HOUR ELSE INTERVAL 0 HOUR END AS arrival
  FROM events)"""

_ACC = """
sf AS (SELECT *, lag(status) OVER (PARTITION BY stat_date, workflow_id ORDER BY seq) AS prev
  FROM wf WHERE status IN ('SUCCESS', 'FAILURE')),
acc AS (SELECT *, lead(seq) OVER (PARTITION BY stat_date, workflow_id ORDER BY seq) AS nxt
  FROM sf WHERE prev IS NULL OR prev <> status)"""

_LATE = """
seen AS (SELECT *, max(stat_date) OVER (ORDER BY arrival, seq) AS today FROM wf),
rolls AS (SELECT *, lag(today) OVER (ORDER BY arrival, seq) AS before FROM seen),
days AS (SELECT *, max(CASE WHEN before < today THEN before END)
    OVER (ORDER BY arrival, seq) AS prev_seen FROM rolls),
openrows AS (SELECT * FROM days WHERE stat_date = today OR stat_date = today - 1)"""

_LATE_ACC = """
sf AS (SELECT *, lag(status) OVER (PARTITION BY stat_date, workflow_id ORDER BY arrival, seq) AS prev
  FROM openrows WHERE status IN ('SUCCESS', 'FAILURE') AND stat_date = today),
live AS (SELECT *, lead(seq) OVER (PARTITION BY stat_date, workflow_id ORDER BY arrival, seq) AS nxt
  FROM sf WHERE prev IS NULL OR prev <> status),
acc AS (SELECT stat_date, typ, cat, mode, status, n_ok, n_bad, bag_nums, nxt FROM live
  UNION ALL SELECT stat_date, typ, cat, mode, status, n_ok, n_bad, bag_nums, NULL FROM openrows
  WHERE status IN ('SUCCESS', 'FAILURE') AND stat_date <> today)"""

_GOOD = "status = 'SUCCESS' AND n_ok > 0"
_BAD = "(status = 'FAILURE' OR n_bad > 0)"
_BAD_N = "CASE status WHEN 'FAILURE' THEN bag_nums ELSE n_bad END"


def _part(name: str, key: str, value: str, where: str, source: str = "acc") -> str:
    return (f"SELECT stat_date, '{name}' AS name, {key} AS key, {value} AS value "
            f"FROM {source} WHERE {where}")


def _pods(name: str, status: str, back: str = "typ") -> list[str]:
    return [_part(name, "typ", "1", f"status = '{status}'"),
            _part(name, back, "-1", f"status = '{status}' AND nxt IS NOT NULL")]


_PARTS = {
    wf.SUCCESS_PODS: _pods(wf.SUCCESS_PODS, "SUCCESS"),
    wf.FAILURE_PODS: _pods(wf.FAILURE_PODS, "FAILURE"),
    wf.REPLAY_OK_BY_CATEGORY: [
        _part(wf.REPLAY_OK_BY_CATEGORY, "cat", "n_ok", f"typ = 'replay' AND {_GOOD}")],
    wf.REPLAY_BAD_BY_CATEGORY: [
        _part(wf.REPLAY_BAD_BY_CATEGORY, "cat", _BAD_N, f"typ = 'replay' AND {_BAD}")],
    wf.REPLAY_OK_BY_MODE: [_part(
        wf.REPLAY_OK_BY_MODE, "mode", "n_ok", f"typ = 'replay' AND mode IS NOT NULL AND {_GOOD}")],
    wf.REPLAY_BAD_BY_MODE: [_part(
        wf.REPLAY_BAD_BY_MODE, "mode", _BAD_N, f"typ = 'replay' AND mode IS NOT NULL AND {_BAD}")],
    wf.OK_BAGS_BY_TYPE: [
        _part(wf.OK_BAGS_BY_TYPE, "typ", "n_ok", f"typ <> 'probe_detect' AND {_GOOD}")],
    wf.BAD_BAGS_BY_TYPE: [
        _part(wf.BAD_BAGS_BY_TYPE, "typ", _BAD_N, f"typ <> 'probe_detect' AND {_BAD}")],
}

_PROFILE = """
prof AS (SELECT stat_date, dev || '.' || cat AS place, profile FROM (
    SELECT stat_date, dev, cat, typ, profile FROM acc
    UNION ALL SELECT stat_date, dev, cat, typ, profile FROM wf
    WHERE status IS NULL OR status NOT IN ('SUCCESS', 'FAILURE'))
  WHERE typ = 'replay' AND profile IS NOT NULL)"""
_PARTS[wf.TIME_CONSUMING] = [
    _part(wf.TIME_CONSUMING, "place || '.total.total'", "profile", "true", "prof"),
    _part(wf.TIME_CONSUMING, "place || '.load.cpu'", "profile / 2", "true", "prof"),
]


def _stats(parts: list[str], ctes: str) -> str:
    return (f"WITH {ctes}, d AS ({' UNION ALL '.join(parts)}) "
            "SELECT stat_date, name, key, round(sum(CAST(value AS DOUBLE)), 4) AS value "
            "FROM d GROUP BY stat_date, name, key")


def _wf_stats(*metrics: str) -> str:
    parts = [p for m in metrics for p in _PARTS[m]]
    ctes = f"{_WF}, {_ACC}"
    if wf.TIME_CONSUMING in metrics:
        ctes += f", {_PROFILE}"
    return _stats(parts, ctes)


_BAG = """
bag AS (SELECT event_id AS seq, CAST(ts AS DATE) AS stat_date, event_type,
    CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 11 = 0 THEN ''
        ELSE 'm' || (event_id % 4) END AS mode,
    CASE user_id % 4 WHEN 0 THEN 'CP' WHEN 1 THEN 'CP' WHEN 2 THEN 'g2' END AS grp,
    CASE event_type WHEN 'error' THEN 'E' || (event_id % 3) WHEN 'view' THEN NULL ELSE '' END AS err,
    's' || (event_id % 2) AS stage,
    CASE WHEN event_id % 6 <> 0 THEN value END AS duration,
    ts + CASE event_id % 50 WHEN 0 THEN INTERVAL 60 HOUR
        WHEN 1 THEN INTERVAL 20 HOUR ELSE INTERVAL 0 HOUR END AS arrival
  FROM events WHERE event_type <> 'click')"""
_BAG_OUT = "event_type <> 'error' AND duration IS NOT NULL"
_BAG_GROUP = _part(bag_stats.DURATION_BY_GROUP, "coalesce(grp, 'null')", "duration", _BAG_OUT, "bag")
_BAG_MODE = _part(bag_stats.DURATION_BY_MODE, "mode", "duration", f"{_BAG_OUT} AND mode <> ''", "bag")
_BAG_ERR = _part(
    bag_stats.ERRORS_BY_GROUP,
    "coalesce(grp, 'null') || '.' || stage || '.' || coalesce(err, 'null')", "1",
    "err IS NULL OR err <> ''", "bag")

_BAG_INFO = f"""
WITH {_BAG},
leaf AS (SELECT stat_date, coalesce(grp, 'null') AS g, stage AS s, coalesce(err, 'null') AS e,
    count(*) AS n FROM bag WHERE err IS NULL OR err <> '' GROUP BY ALL),
l3 AS (SELECT stat_date, g, s, '"' || e || '":' || n AS t FROM leaf),
l2 AS (SELECT stat_date, g, '"' || s || '":{{' || string_agg(t, ',' ORDER BY t) || '}}' AS t
  FROM l3 GROUP BY stat_date, g, s),
l1 AS (SELECT stat_date, '"' || g || '":{{' || string_agg(t, ',' ORDER BY t) || '}}' AS t
  FROM l2 GROUP BY stat_date, g)
SELECT '{bag_stats.ERRORS_BY_GROUP}' AS name, 'daily' AS period,
  strftime(stat_date, '%Y-%m-%d 00:00:00') AS stat_date,
  '{{' || string_agg(t, ',' ORDER BY t) || '}}' AS info
FROM l1 GROUP BY l1.stat_date"""

_COUNTER_RECORDS = f"""
WITH {_WF}, {_ACC}, d AS ({' UNION ALL '.join(p for m in wf.COUNTERS for p in _PARTS[m])}),
s AS (SELECT stat_date, name, '"' || key || '":' || CAST(sum(value) AS BIGINT) AS t
  FROM d GROUP BY stat_date, name, key)
SELECT name, 'daily' AS period, strftime(stat_date, '%Y-%m-%d 00:00:00') AS stat_date,
  '{{' || string_agg(t, ',' ORDER BY t) || '}}' AS info
FROM s GROUP BY name, s.stat_date"""

_BAG_LATE = """
seen AS (SELECT *, max(stat_date) OVER (ORDER BY arrival, seq) AS today FROM bag),
kept AS (SELECT * FROM seen WHERE stat_date = today OR stat_date = today - 1)"""

_NUMBERED = """
num AS (SELECT l_orderkey || '-' || l_linenumber || '-' || row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS id,
    l_orderkey AS k, l_linestatus AS log, l_returnflag AS error_type FROM lineitem)"""

_NODE = """
node AS (SELECT event_id AS seq, 'c' || (user_id % 2) AS cluster_name,
    'n' || (user_id % 20) AS node_name, 'f' || (event_id % 3) AS fault_type,
    CASE WHEN event_type IN ('error', 'click') THEN 'fault' WHEN event_type = 'view' THEN 'health'
        ELSE 'unknown' END AS route, epoch_us(ts) / 1000000.0::DOUBLE AS t, ts FROM events),
lev AS (SELECT *, lag(route) OVER (PARTITION BY cluster_name, node_name, fault_type ORDER BY seq)
    AS prev FROM node WHERE route <> 'unknown'),
edge AS (SELECT *, lead(t) OVER w AS end_time, lead(seq) OVER w AS close_seq, lead(ts) OVER w AS end_ts
  FROM lev WHERE prev IS NULL OR prev <> route
  WINDOW w AS (PARTITION BY cluster_name, node_name, fault_type ORDER BY seq)),
ses AS (SELECT cluster_name, node_name, fault_type, seq AS open_seq, close_seq, t AS start_time,
    end_time, CAST(trunc((end_time - t) / 60) AS BIGINT) AS minutes, ts, end_ts
  FROM edge WHERE route = 'fault')"""

_BY_ARRIVAL = ("ORDER BY seq", "ORDER BY arrival, seq")
_NODE_ARRIVAL = _NODE.replace("AS t, ts FROM events)", f"""AS t, ts,
    ts + CASE event_id % 50 WHEN 0 THEN INTERVAL 60 HOUR
        WHEN 1 THEN INTERVAL 20 HOUR ELSE INTERVAL 0 HOUR END AS arrival FROM events)""").replace(
    *_BY_ARRIVAL)

# where the layout of a profile changes, only what came after the last change counts
_CLASH = """
place AS (SELECT seq, stat_date, dev || '.' || cat AS place, profile, seq % 9 = 0 AS plain FROM (
    SELECT seq, stat_date, dev, cat, typ, profile FROM acc
    UNION ALL SELECT seq, stat_date, dev, cat, typ, profile FROM wf
    WHERE status IS NULL OR status NOT IN ('SUCCESS', 'FAILURE'))
  WHERE typ = 'replay' AND profile IS NOT NULL),
newest AS (SELECT stat_date, place, coalesce(max(CASE WHEN plain THEN seq END), -1) AS last_plain,
    coalesce(max(CASE WHEN NOT plain THEN seq END), -1) AS last_nested FROM place GROUP BY ALL),
d AS (SELECT stat_date, place || '.total.total' AS key, profile AS value FROM place
  UNION ALL SELECT stat_date, place || '.load.cpu', profile / 2 FROM place
    JOIN newest USING (stat_date, place)
    WHERE last_nested > last_plain AND NOT plain AND seq > last_plain
  UNION ALL SELECT stat_date, place || '.load', profile FROM place
    JOIN newest USING (stat_date, place)
    WHERE last_plain > last_nested AND plain AND seq > last_nested)"""

_SEEDED = _LATE.replace("max(stat_date) OVER (ORDER BY arrival, seq) AS today FROM wf",
                        "greatest(max(stat_date) OVER (ORDER BY arrival, seq), "
                        f"DATE '{SEED_DAY}') AS today FROM wf")

_JOB = """
fail AS (SELECT 'n' || user_id AS node_name, 'wf' || (event_id % 40) AS workflow,
    make_timestamp((1704067200000 + (epoch_us(ts) - 1704067200000000) // 600000) * 1000) AS ts
  FROM events WHERE event_type <> 'purchase' AND event_id % 4 <> 0),
el AS (SELECT node_name, workflow, ts,
    make_timestamp(epoch_us(ts) // 10000000 * 10000000 - i * 10000000) AS window_start
  FROM fail, range(30) r(i)),
win AS (SELECT node_name, window_start, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts
  FROM el GROUP BY node_name, window_start)"""
_CHAIN = """
hot AS (SELECT * FROM win WHERE n >= 5),
chain AS (
  SELECT node_name, min(window_start) AS ws, arg_min(last_ts, window_start) AS l
  FROM hot GROUP BY node_name
  UNION ALL
  SELECT h.node_name, min(h.window_start), arg_min(h.last_ts, h.window_start)
  FROM chain c JOIN hot h ON h.node_name = c.node_name
    AND h.first_ts > c.l + INTERVAL 5 MINUTE GROUP BY h.node_name),
al AS (SELECT h.node_name, h.window_start, any_value(h.n) AS n, any_value(h.first_ts) AS first_ts,
    any_value(h.last_ts) AS last_ts, max(c.l) AS last_alert, count(*) AS upto,
    CASE WHEN max(c.ws) = h.window_start THEN 'alert' ELSE 'cooling' END AS outcome
  FROM hot h JOIN chain c ON c.node_name = h.node_name AND c.ws <= h.window_start
  GROUP BY h.node_name, h.window_start)"""


def _actions(period: str) -> str:
    return f"""
WITH RECURSIVE {_JOB}, {_CHAIN},
per AS (SELECT node_name, window_start, {period} AS period FROM al)
SELECT node_name, min(window_start) AS window_start, 'cordon' AS kind, node_name AS target
FROM per GROUP BY node_name, period
UNION ALL
SELECT p.node_name, min(p.window_start) AS window_start, 'raise_priority' AS kind,
  e.workflow AS target
FROM per p JOIN el e ON e.node_name = p.node_name AND e.window_start = p.window_start
GROUP BY p.node_name, p.period, e.workflow"""


_TABLE = """
wt AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS workflow_id,
    CASE o_orderstatus WHEN 'F' THEN 'FAILURE' WHEN 'O' THEN 'SUCCESS' ELSE 'RUNNING' END
      AS workflow_status,
    o_orderpriority AS tag, o_orderdate AS create_time, c_mktsegment AS category,
    o_totalprice / 1000 AS upload_ttl, CAST(o_orderkey % 5 AS INTEGER) AS bag_nums
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
rt AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS id,
    l_orderkey AS k, CAST(l_orderkey AS VARCHAR) AS workflow_id_id, l_shipdate AS create_time,
    l_linestatus AS log, l_returnflag AS error_type FROM lineitem)"""
_CHOSEN = f"create_time >= TIMESTAMP '{RANGE_START}' AND create_time < TIMESTAMP '{RANGE_END}'"
_COPY_DAY = (f"create_time >= DATE '{AS_OF}' - 31 AND create_time < DATE '{AS_OF}' - 30")
_COPY = """
lake AS (SELECT k, workflow_id, CASE WHEN k % 83 <> 0 THEN tag END AS tag, create_time,
    CASE WHEN k % 89 = 0 THEN bag_nums + 1 ELSE bag_nums END AS bag_nums
  FROM wt WHERE k % 97 <> 0
  UNION ALL SELECT NULL, 'x' || workflow_id, tag, create_time, bag_nums FROM wt WHERE k < 5)"""

_PLAN = f"""
sec AS (SELECT create_time AS second, count(*) AS n FROM wt GROUP BY create_time),
run AS (SELECT *, date_trunc('month', second) AS slice, CAST(sum(n) OVER (
    PARTITION BY date_trunc('month', second) ORDER BY second) AS BIGINT) AS upto FROM sec),
own AS (SELECT *, (upto - n) // {PLAN_ROWS} AS bin,
    CASE WHEN (upto - n) // {PLAN_ROWS} <> (upto - 1) // {PLAN_ROWS} THEN second END AS own FROM run),
plan AS (SELECT min(second) AS range_start, max(second) + INTERVAL 1 SECOND AS range_end,
    CAST(sum(n) AS BIGINT) AS n, CAST(ceil(sum(n) / {PLAN_ROWS}.0) AS BIGINT) AS pages
  FROM own GROUP BY slice, bin, own)"""

_TOTALS = f"""
WITH {_BAG},
s AS (SELECT stat_date, name, key, sum(value) AS v FROM ({_BAG_GROUP} UNION ALL {_BAG_MODE})
  GROUP BY stat_date, name, key HAVING stat_date >= DATE '2024-01-05'
    AND stat_date < DATE '2024-01-20'),
t AS (SELECT name, key, CAST(trunc(round(sum(v), 6)) AS BIGINT) AS value_left,
    CAST(trunc(round(coalesce(sum(CASE WHEN key <> 'g2'
        THEN v + CASE WHEN day(stat_date) % 2 = 0 THEN 1 ELSE 0 END END), 0), 6)) AS BIGINT)
      AS value_right
  FROM s GROUP BY name, key)
SELECT *, value_left - value_right AS diff, round_even(CASE WHEN value_right <> 0 THEN
  CAST(value_left - value_right AS DOUBLE) / value_right * 100 END, 2) AS diff_percent FROM t"""

_TAG = " ".join(f"WHEN contains(text, '{m}') THEN '{m}'" for m in LOG_MARKERS)
_UNITS = ("minute", "day", "week", "month")
_BUCKETS = ", ".join(
    [f"CAST(date_trunc('{u}', ts) AS TIMESTAMP) AS {u}" for u in _UNITS]
    + [f"strftime(date_trunc('{u}', ts), '%Y-%m-%d %H:%M:%S') AS {u}_text" for u in _UNITS]
    + [f"CAST(epoch(date_trunc('{u}', ts)) AS BIGINT) AS {u}_epoch" for u in _UNITS])

ORACLES: dict[str, str] = {
    "bag_duration_by_group": _stats([_BAG_GROUP], _BAG),
    "bag_duration_by_mode": _stats([_BAG_MODE], _BAG),
    "bag_error_nested": _stats([_BAG_ERR], _BAG),
    "bag_error_info": _BAG_INFO,
    "bag_late_statistics": _stats([
        p.replace(" FROM bag ", " FROM kept ") for p in (_BAG_GROUP, _BAG_MODE, _BAG_ERR)
    ], f"{_BAG}, {_BAG_LATE}"),
    "wf_transitions": f"""WITH {_WF}, {_ACC}
        SELECT stat_date, workflow_id, seq, 1 AS sign, status AS workflow_status,
          typ AS workflow_type FROM acc
        UNION ALL SELECT stat_date, workflow_id, nxt, -1, status, typ FROM acc
        WHERE nxt IS NOT NULL""",
    "wf_pods_by_type": _wf_stats(wf.SUCCESS_PODS, wf.FAILURE_PODS),
    "wf_pods_category_retraction": _stats(
        _pods(wf.SUCCESS_PODS, "SUCCESS", "cat") + _pods(wf.FAILURE_PODS, "FAILURE", "cat"),
        f"{_WF}, {_ACC}"),
    "wf_bags_by_category": _wf_stats(wf.REPLAY_OK_BY_CATEGORY, wf.REPLAY_BAD_BY_CATEGORY),
    "wf_bags_by_mode": _wf_stats(wf.REPLAY_OK_BY_MODE, wf.REPLAY_BAD_BY_MODE),
    "wf_bags_by_type": _wf_stats(wf.OK_BAGS_BY_TYPE, wf.BAD_BAGS_BY_TYPE),
    "wf_time_consuming": _wf_stats(wf.TIME_CONSUMING),
    "wf_daily_statistics": _wf_stats(*wf.ALL_METRICS),
    "wf_counter_records": _COUNTER_RECORDS,
    "wf_late_drop": f"""WITH {_WF}, {_LATE}
        SELECT seq, stat_date, stat_date = today AS is_today FROM openrows""",
    "wf_late_drop_prev_seen": f"""WITH {_WF}, {_LATE}
        SELECT seq, stat_date, stat_date = today AS is_today FROM days
        WHERE stat_date = today OR stat_date = prev_seen""",
    "wf_late_statistics": _stats(
        [p for m in wf.COUNTERS for p in _PARTS[m]], f"{_WF}, {_LATE}, {_LATE_ACC}"),
    "fault_sessions": f"""WITH {_NODE} SELECT cluster_name, node_name, fault_type, open_seq,
        close_seq, start_time, end_time, minutes FROM ses""",
    "fault_sessions_by_arrival": f"""WITH {_NODE_ARRIVAL} SELECT cluster_name, node_name,
        fault_type, open_seq * {WIDE} AS open_seq, close_seq * {WIDE} AS close_seq, start_time,
        end_time, minutes FROM ses""",
    "wf_statistics_by_arrival": _stats([p for m in wf.COUNTERS for p in _PARTS[m]],
                                       f"{_WF}, {_ACC.replace(*_BY_ARRIVAL)}"),
    "wf_time_consuming_clash": f"""WITH {_WF}, {_ACC}, {_CLASH}
        SELECT stat_date, '{wf.TIME_CONSUMING}' AS name, key,
          round(sum(CAST(value AS DOUBLE)), 4) AS value FROM d GROUP BY stat_date, key""",
    "wf_late_drop_seeded": f"""WITH {_WF}, {_SEEDED}
        SELECT seq, stat_date, stat_date = today AS is_today FROM openrows""",
    "bag_last_duration": f"""WITH {_BAG}, d AS ({_BAG_GROUP.replace(' FROM bag', ', seq FROM bag')})
        SELECT stat_date, name, key, round(CAST(arg_max(value, seq) AS DOUBLE), 4) AS value
        FROM d GROUP BY stat_date, name, key""",
    "retention_as_of": f"""WITH {_TABLE} SELECT workflow_id, workflow_status, create_time FROM wt
        WHERE NOT (create_time >= DATE '{RETAIN_AS_OF}' - {KEEP_DAYS + 1}
          AND create_time < DATE '{RETAIN_AS_OF}' - {KEEP_DAYS})""",
    "fault_alerts": f"""WITH {_NODE}
        SELECT cluster_name, node_name, fault_type, 'fault' AS level, open_seq AS seq,
          CAST(NULL AS BIGINT) AS minutes, 'FAULT! ' || fault_type || ' on machine ' || node_name
          || ' in cluster ' || cluster_name || ' found at '
          || strftime(ts, '%Y-%m-%d %H:%M:%S') || '.' AS info FROM ses
        UNION ALL SELECT cluster_name, node_name, fault_type, 'recovery', close_seq, minutes,
          'Recovery! ' || fault_type || ' on machine ' || node_name || ' in cluster '
          || cluster_name || ' recovered at ' || strftime(end_ts, '%Y-%m-%d %H:%M:%S')
          || '. Fault duration: ' || minutes || ' minutes.' FROM ses WHERE end_time IS NOT NULL""",
    "node_routes": f"WITH {_NODE} SELECT seq, node_name, route FROM node",
    "burst_windows": f"WITH {_JOB} SELECT * FROM win",
    "burst_alerts": f"""WITH RECURSIVE {_JOB}, {_CHAIN}
        SELECT node_name, window_start, n, first_ts, last_ts, last_alert, outcome FROM al""",
    "burst_results": f"""WITH RECURSIVE {_JOB}, {_CHAIN}
        SELECT w.node_name, w.window_start, w.n, coalesce(al.outcome, 'normal') AS outcome,
          CASE al.outcome WHEN 'alert' THEN 'alert: ' || strftime(last_alert, '%Y-%m-%d %H:%M:%S')
            WHEN 'cooling' THEN 'cooling, last: ' || strftime(last_alert, '%Y-%m-%d %H:%M:%S')
            ELSE 'normal: ' || w.n END AS result
        FROM win w LEFT JOIN al ON al.node_name = w.node_name
          AND al.window_start = w.window_start""",
    "burst_actions": _actions("upto"),
    "burst_actions_clear_after": _actions(
        "greatest(upto - CASE outcome WHEN 'alert' THEN 1 ELSE 0 END - 1, 0)"),
    "burst_action_records": f"""SELECT node_name, window_start, kind,
        string_agg(target, ',' ORDER BY target) AS targets FROM ({_actions("upto")}) GROUP BY ALL""",
    "burst_alert_records": f"""WITH RECURSIVE {_JOB}, {_CHAIN}
        SELECT node_name, window_start, outcome,
          CASE outcome WHEN 'alert' THEN 'burst' END AS level,
          CASE outcome WHEN 'alert' THEN last_ts END AS time,
          CASE outcome WHEN 'alert' THEN 'node ' || node_name || ': ' || n
            || ' failed replays from ' || strftime(first_ts, '%Y-%m-%d %H:%M:%S') || ' to '
            || strftime(last_ts, '%Y-%m-%d %H:%M:%S') END AS info FROM al""",
    "failures_per_day_offset": f"""SELECT
        date_trunc('day', ts + INTERVAL 8 HOUR) - INTERVAL 8 HOUR AS window_start,
        {_STATUS} AS status, count(*) AS n FROM events
        WHERE event_type NOT IN ('purchase', 'signup') GROUP BY ALL""",
    "log_tags": f"SELECT doc_id, CASE {_TAG} ELSE '{LOG_FALLBACK}' END AS tag FROM documents",
    "probe_levels": """SELECT doc_id, CASE WHEN doc_id % 5 = 0 OR contains(lower(text), 'err!')
        THEN 'fault' ELSE 'health' END AS level FROM documents""",
    "crash_filter": """SELECT 'r-' || event_id AS result_id, 'replay' AS type,
        'FAILURE' AS status, CASE user_id % 4 WHEN 0 THEN 'cp' WHEN 1 THEN 'CP' WHEN 2 THEN 'g2' END
          AS "group", 'E' || (event_id % 3) AS error_type, 's' || (event_id % 2) AS error_stage,
        CASE WHEN event_id % 9 = 0 THEN '' ELSE 'trace ' || event_id END AS backtrace
        FROM events WHERE event_type = 'error' AND event_id % 2 <> 0""",
    "cdc_latest": f"""WITH {_TABLE} SELECT workflow_id, workflow_status, tag AS _tag, category,
        create_time, CAST(round(CASE WHEN k % 3 = 0 THEN upload_ttl + 1 ELSE upload_ttl END)
        AS INTEGER) AS upload_ttl, bag_nums FROM wt""",
    "cdc_snapshot_then_log": f"""WITH {_TABLE} SELECT workflow_status, count(*) AS n, round(sum(
        CASE WHEN k % 3 = 0 THEN upload_ttl + 1 ELSE upload_ttl END), 3) AS ttl
        FROM wt GROUP BY workflow_status""",
    "times_as_text": f"""WITH {_TABLE} SELECT id, workflow_id_id,
        strftime(create_time, '%Y-%m-%d %H:%M:%S.%f') AS create_time,
        strftime(create_time, '%Y-%m-%d %H:%M:%S.%f') AS update_time FROM rt""",
    "inner_child_rows": f"""WITH {_TABLE}
        SELECT id, workflow_id_id, rt.create_time, log, error_type FROM rt
        JOIN (SELECT k FROM wt WHERE {_CHOSEN}) p ON p.k = rt.k""",
    "semi_child_rows": f"""WITH {_TABLE}
        SELECT id, workflow_id_id, create_time, log, error_type FROM rt
        WHERE k IN (SELECT k FROM wt WHERE {_CHOSEN})""",
    "incremental_parents": f"""WITH {_TABLE} SELECT workflow_id, workflow_status, tag AS _tag,
        create_time, CAST(round(upload_ttl) AS INTEGER) AS upload_ttl FROM wt WHERE {_COPY_DAY}""",
    "incremental_children": f"""WITH {_TABLE} SELECT id, workflow_id_id, create_time, log FROM rt
        WHERE k IN (SELECT k FROM wt WHERE {_COPY_DAY})""",
    "range_plan": f"WITH {_TABLE}, {_PLAN} SELECT * FROM plan",
    "range_rows": f"""WITH {_TABLE}, {_PLAN} SELECT workflow_id, range_start,
          CAST('0x' || substr(md5(CAST(workflow_id AS VARCHAR)), 1, 15) AS BIGINT) % pages AS page
        FROM wt JOIN plan
        ON create_time >= range_start AND create_time < range_end""",
    "retention_parents": f"""WITH {_TABLE} SELECT workflow_id, workflow_status, create_time
        FROM wt WHERE NOT ({_CHOSEN})""",
    "retention_children": f"""WITH {_TABLE} SELECT id, workflow_id_id, create_time, log FROM rt
        WHERE k NOT IN (SELECT k FROM wt WHERE {_CHOSEN})""",
    "recon_counts": f"""WITH {_TABLE}, {_COPY},
        l AS (SELECT create_time AS bucket, count(*) AS n FROM wt GROUP BY ALL),
        r AS (SELECT create_time AS bucket, count(*) AS n FROM lake GROUP BY ALL)
        SELECT coalesce(l.bucket, r.bucket) AS bucket, coalesce(l.n, 0) AS n_left,
          coalesce(r.n, 0) AS n_right, coalesce(l.n, 0) = coalesce(r.n, 0) AS match
        FROM l FULL JOIN r ON l.bucket = r.bucket""",
    "recon_child_counts": f"""WITH {_TABLE},
        l AS (SELECT wt.create_time AS bucket, count(*) AS n FROM rt JOIN wt ON wt.k = rt.k
          GROUP BY ALL),
        r AS (SELECT create_time AS bucket, count(*) AS n FROM rt GROUP BY ALL)
        SELECT coalesce(l.bucket, r.bucket) AS bucket, coalesce(l.n, 0) AS n_left,
          coalesce(r.n, 0) AS n_right, coalesce(l.n, 0) = coalesce(r.n, 0) AS match
        FROM l FULL JOIN r ON l.bucket = r.bucket""",
    "recon_fields": f"""WITH {_TABLE}
        SELECT workflow_id, '<missing right>' AS "column", workflow_id AS left_value,
          CAST(NULL AS VARCHAR) AS right_value FROM wt WHERE k % 97 = 0
        UNION ALL SELECT 'x' || workflow_id, '<missing left>', NULL, 'x' || workflow_id
        FROM wt WHERE k < 5
        UNION ALL SELECT workflow_id, 'bag_nums', CAST(bag_nums AS VARCHAR),
          CAST(bag_nums + 1 AS VARCHAR) FROM wt WHERE k % 97 <> 0 AND k % 89 = 0
        UNION ALL SELECT workflow_id, 'tag', tag, NULL FROM wt
        WHERE k % 97 <> 0 AND k % 83 = 0 AND tag IS NOT NULL""",
    "recon_result_fields": f"""WITH {_NUMBERED}
        SELECT id, '<missing right>' AS "column", id AS left_value,
          CAST(NULL AS VARCHAR) AS right_value FROM num WHERE k % 97 = 0
        UNION ALL SELECT id, 'log', log, 'changed' FROM num WHERE k % 97 <> 0 AND k % 89 = 0
        UNION ALL SELECT id, 'error_type', error_type, NULL FROM num
        WHERE k % 97 <> 0 AND k % 83 = 0""",
    "recon_stats": _TOTALS,
    "recon_time_profile": f"""WITH {_WF}, {_ACC}, {_PROFILE}
        SELECT split_part(place, '.', 1) AS name, split_part(place, '.', 2) AS key,
          round(sum(profile), 4) AS value FROM prof GROUP BY ALL""",
    "time_buckets": f"""SELECT event_id, {_BUCKETS},
        CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch,
        CAST(date_trunc('second', ts) AS TIMESTAMP) AS parsed,
        CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS parsed_epoch,
        ts + INTERVAL 9 HOUR AS shifted FROM events""",
    "page_rows": f"""WITH {_TABLE} SELECT workflow_id, create_time FROM wt
        ORDER BY create_time, workflow_id LIMIT 100 OFFSET 200""",
}

# Fixed value used above: this zone is nine hours ahead of UTC all year.
assert ZONE == "Asia/Tokyo"
