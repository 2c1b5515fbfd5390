"""Spark result against DuckDB result: schema names, row count and values, in any order."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if value != value else float(f"{value:.10g}")
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def compare(df, con, sql: str) -> list[str]:
    """Differences, none when the results are the same."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    expected_rows = rel.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    pick = [names.index(c) for c in order]
    expected = sorted((tuple(plain(r[i]) for i in pick) for r in expected_rows), key=repr)
    actual = sorted((tuple(plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in order]).collect()), key=repr)
    if len(expected) != len(actual):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    for a, e in zip(actual, expected):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            problems.append(f"first difference: {a} != {e}")
            break
    return problems
