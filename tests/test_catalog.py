"""Every catalog query against its SQL in DuckDB on the same tables."""

import datetime
import decimal
import os

import duckdb
import numpy as np
import pytest

from gaugework.plans import catalog
from gaugework.session import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and v != v:
        return "~"
    if isinstance(v, (float, np.floating, decimal.Decimal)):
        return repr(float(v) + 0.0)
    if isinstance(v, datetime.datetime):
        return str(v.replace(tzinfo=None))
    return str(v)


def table(rows, columns):
    at = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(plain(r[k]) for k in at) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in catalog.ORACLE:
        assert rows
        return
    found = duck.execute(catalog.ORACLE[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert table(rows, df.columns) == table(found.fetchall(), columns)


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filters_reach_the_scan(spark):
    plan = catalog.QUERIES["range_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "o_totalprice" in plan.split("PushedFilters")[1]
