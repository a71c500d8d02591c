"""Every bound query against its DuckDB twin on the smallest test tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from lapforge.plans import bindings

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return round(v, 9) if isinstance(v, float) else v


def rows(names, found):
    return sorted(repr([plain(v) for _, v in sorted(zip(names, r, strict=True))]) for r in found)


@pytest.mark.parametrize("name", sorted(bindings.QUERIES))
def test_twin(spark, duck, name):
    df = bindings.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in bindings.ORACLES:
        twin = duck.sql(bindings.ORACLES[name])
        assert sorted(twin.columns) == sorted(df.columns)
        assert got == rows(twin.columns, twin.fetchall())
    else:
        assert got
