"""A query's rows against those of its SQL."""

from __future__ import annotations

import math
from pathlib import Path


def plain(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, float):
        return repr(round(x, 6) + 0.0)
    if isinstance(x, (list, tuple)):
        return str([plain(y) for y in x])
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


def same(df, sql: str, path: str) -> None:
    import duckdb

    con = duckdb.connect()
    for p in Path(path).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else str(p) + '/*.parquet'}')")
    want = con.sql(sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(want.columns, want.fetchall())
