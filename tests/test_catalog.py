"""Every query of the catalogue that has a DuckDB oracle against it, at sf0.001
(``python tools/check.py`` does the same at other sizes)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from salescast.plans import catalog
from tests.conftest import SF_SMALL

def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_registry_complete():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert len(qs) >= 130 and set(sql) <= set(qs)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "year", "revenue"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    srows = sorted((tuple(_norm(v) for v in r) for r in sdf.collect()), key=_key)
    cur = con.execute(entry.oracle_sql()[name])
    drows = sorted((tuple(_norm(v) for v in r) for r in cur.fetchall()), key=_key)
    assert sdf.columns == [d[0] for d in cur.description]
    assert srows == drows
