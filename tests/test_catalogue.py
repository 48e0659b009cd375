"""Every named query against independent SQL on the provided tables."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from ridelake.catalog.oracle import oracle_sql
from ridelake.catalog.queries import queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = Counter(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())

    cursor = duck.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    plain = lambda v: float(v) if isinstance(v, Decimal) else v
    expected = Counter(repr(tuple(plain(r[i]) for i in order)) for r in cursor.fetchall())
    assert found == expected
    assert found


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["date_kr", "region", "driver_type"]
