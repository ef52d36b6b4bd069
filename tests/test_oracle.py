"""Every registered query against its SQL twin on the smoke data."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events".split()
# the queries of optional parts have tests of their own
QUERIES, ORACLES = {n: q for n, q in entry.queries().items() if n in entry._QUERIES}, entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{entry.SMOKE_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value + 0.0)
    return "NULL" if value is None else str(value)


def test_each_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    found = QUERIES[name](spark, entry.SMOKE_DIR)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(found.columns) == sorted(columns)
    expected = sorted(tuple(plain(v) for v in row) for row in result.fetchall())
    assert sorted(tuple(plain(r[c]) for c in columns) for r in found.collect()) == expected
