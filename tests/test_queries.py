"""Every registered query against its SQL on the small tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tripmart import oracle
from tripmart.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()
EXPECTED = oracle.statements()

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(EXPECTED)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(EXPECTED) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    relation = duck.sql(EXPECTED[name])
    assert sorted(relation.columns) == names
    index = [relation.columns.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in index) for r in relation.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0 and "trip_count" in df.columns
