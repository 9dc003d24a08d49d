"""Each query on plain tables against its SQL, over the smallest data."""

from collections import Counter

import duckdb
import pytest

from tessella.plans import driver

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark", "pages", "labels", "conversations")
EMPTY_HERE: set[str] = set()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(f"{v[i]:.9g}" if isinstance(v[i], float) else str(v[i]) for i in order) for v in values)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_gives_the_rows_of_its_sql(spark, db, name):
    got = driver.queries()[name](spark, DATA)
    want = db.sql(driver.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    got_rows = rows(got.columns, got.collect())
    assert got_rows == rows(want.columns, want.fetchall())
    assert got_rows or name in EMPTY_HERE
