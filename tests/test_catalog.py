"""Each query against its oracle SQL."""

import math
from pathlib import Path

import duckdb
import pytest

from pairloom import catalog

SF = "/root/testdata/sf0.01"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return [columns[i] for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    df = catalog.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows or name in ("link_reject",)
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        return
    got = con.sql(sql)
    assert rows_of(df.columns, rows) == rows_of(got.columns, got.fetchall())
