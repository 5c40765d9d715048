"""Compares a query with its SQL, without regard to row order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

FOLDER = "/root/testdata/sf0.01"


def connect(folder: str = FOLDER):
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return 0.0 if value == 0 else value
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))


def compare(spark, con, build, sql, folder: str = FOLDER):
    df = build(spark, folder)
    got_names, got = table(df.columns, df.collect())
    cur = con.execute(sql)
    types = [str(d[1]) for d in cur.description]
    want_names, want = table([d[0] for d in cur.description], cur.fetchall())
    assert got_names == want_names, (got_names, want_names)
    assert len(got) == len(want), (len(got), len(want))
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    assert not bad, (len(bad), bad[:5])
    return df, types
