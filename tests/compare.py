"""Spark rows against DuckDB rows, order aside."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float) or type(x).__name__ == "Decimal":
        return round(float(x), 9)
    return x


def sort_key(row):
    return [(x is None, str(type(x)), x if x is not None else 0) for x in row]


def against_sql(df, sql: str, sf_dir: str) -> tuple[list, list]:
    con = duckdb.connect()
    for table in Path(sf_dir).iterdir():
        con.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    theirs = [tuple(float(v) if isinstance(v := plain(dict(zip(names, r, strict=True))[c]), int) and not isinstance(v, bool) else v for c in order) for r in found.fetchall()]
    ours = [tuple(float(v) if isinstance(v := plain(r[c]), int) and not isinstance(v, bool) else v for c in order) for r in df.collect()]
    return sorted(ours, key=sort_key), sorted(theirs, key=sort_key)
