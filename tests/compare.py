"""Runs a query and its SQL side by side and tells how the rows differ."""

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return str([_plain(v) for v in value])
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(con, df, sql):
    """None when both sides agree, else a short text."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    found = [tuple(r) for r in df.collect()]
    if len(found) != len(expected):
        return f"{len(found)} rows instead of {len(expected)}"
    ours, theirs = rows_of(df.columns, found), rows_of(names, expected)
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} instead of {b}"
    return None
