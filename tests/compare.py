"""Holds a Spark result against a DuckDB result, whatever the order of rows."""

import datetime
import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).iterdir():
        files = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.name.removesuffix('.parquet')} AS SELECT * FROM '{files}'")
    return con


def value(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, datetime.datetime):
        return x.date().isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, float):
        return round(x, 5) + 0.0
    return float(x) if isinstance(x, int) else x


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(value(r[i]) for i in order)) for r in data)


def assert_same(df, con, sql):
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want)
    assert got == want
