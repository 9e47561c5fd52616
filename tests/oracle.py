"""Run a registered query and its SQL twin on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return float(v) if isinstance(v, float) else v


def _rows(table):
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return cols, Counter(tuple(_cell(v) for v in row) for row in zip(*data))


def _kind(t):
    s = str(t)
    for a, b in (("large_string", "string"), ("timestamp[us]", "timestamp"),
                 ("timestamp[ns]", "timestamp")):
        s = s.replace(a, b)
    return s


def compare(spark, con, query, sql, sf_dir) -> str | None:
    """None when equal, else what differs."""
    ours = query(spark, sf_dir).toArrow()
    theirs = con.sql(sql).to_arrow_table()
    cols, got = _rows(ours)
    ref_cols, want = _rows(theirs)
    if cols != ref_cols:
        return f"columns {cols} != {ref_cols}"
    kinds = {c: (_kind(ours.schema.field(c).type), _kind(theirs.schema.field(c).type)) for c in cols}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if bad:
        return f"types {bad}"
    if got != want:
        a, b = got - want, want - got
        return (f"{sum(a.values())} rows only here, {sum(b.values())} only in SQL of "
                f"{sum(want.values())}; {cols}: {list(a)[:3]} / {list(b)[:3]}")
    if not want:
        return "no rows"
    return None
