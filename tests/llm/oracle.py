"""Compares a query with its oracle SQL run by DuckDB over the same tables."""

import math
from pathlib import Path

import duckdb


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def same(df, sql, sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = con.sql(sql)
    want = rows_of(got.columns, got.fetchall())
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine[0] == want[0]
    assert mine[1] == want[1]
    return len(mine[1])
