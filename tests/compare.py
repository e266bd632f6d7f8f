"""Run a registered query and its SQL over the same tables and list the differences."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    if isinstance(value, int):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_cols, want = _sorted_rows(names, result.fetchall())
    got_cols, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if want_cols != got_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
    if len(want) != len(got):
        problems.append(f"rows {len(got)} != {len(want)}")
    if want != got:
        left, right = set(got) - set(want), set(want) - set(got)
        problems.append(f"{len(left)} odd rows, e.g. {sorted(left)[:2]} vs {sorted(right)[:2]}")
    return problems
