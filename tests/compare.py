"""Comparison of a query's rows with those of its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def sql_rows(folder: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(folder).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)


def frame_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
