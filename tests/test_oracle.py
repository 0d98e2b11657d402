"""Every catalogued query against its SQL twin in DuckDB, on the smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlark.plans import catalog
from ledgerlark.sources.driver_tables import TABLES
from tests.conftest import SF_SMALL

ORACLE = entry.oracle_sql()


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (2, str(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        return (1, "nan") if math.isnan(f) else (1, repr(round(f, 9)))
    if isinstance(v, (dt.date, dt.datetime)):
        return (3, v.isoformat())
    if isinstance(v, (list, tuple)):
        return (4, repr([_norm(x) for x in v]))
    return (5, str(v))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_retail_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = [ocols.index(cols[i]) for i in order]
    a = sorted(tuple(_norm(r[i]) for i in order) for r in got)
    b = sorted(tuple(_norm(r[i]) for i in oorder) for r in want)
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_date", "total_orders", "paid_orders", "canceled_orders",
                          "gross_revenue", "avg_order_value"]
