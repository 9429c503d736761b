"""Runs a query and its SQL over the same tables and compares the rows, as the driver does."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

DATA = "/root/testdata"


def canon(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(canon(x) for x in v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canon(r[i]) for i in order) for r in rows), key=repr)


def oracle(sql: str, folder: str):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in os.listdir(folder):
        name = f.removesuffix(".parquet")
        p = f"{folder}/{f}" + ("/*.parquet" if os.path.isdir(f"{folder}/{f}") else "")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p}'")
    r = c.execute(sql)
    return [d[0] for d in r.description], r.fetchall()


def differences(spark, query, sql: str, folder: str, most: int = 5):
    """None if equal, else a text."""
    df = query(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cols, rows = oracle(sql, folder)
    want = rows_of(cols, rows)
    if sorted(df.columns) != sorted(cols):
        return f"columns {sorted(df.columns)} and {sorted(cols)}"
    if got == want:
        return None
    a, b = set(map(repr, got)), set(map(repr, want))
    return f"{len(got)} and {len(want)} rows; only here: {sorted(a - b)[:most]}; only in SQL: {sorted(b - a)[:most]}"
