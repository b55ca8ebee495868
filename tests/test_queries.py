"""Every query of the library against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tidemark.plans import market

DATA = os.environ.get("TIDEMARK_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    if not os.path.isdir(DATA):
        pytest.skip("no tables")
    db = duckdb.connect()
    for name in ("events", "lineitem"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return db


def same(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(market.QUERIES))
def test_query_equals_sql(spark, tables, name):
    got = market.QUERIES[name](spark, DATA)
    cursor = tables.execute(market.SQL[name])
    columns = [c[0] for c in cursor.description]
    want = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    rows = [tuple(map(same, r)) for r in got.select(*columns).collect()]
    assert sorted(rows, key=repr) == sorted([tuple(map(same, r)) for r in want], key=repr)
