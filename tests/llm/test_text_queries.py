"""Registered queries of the text operators on the small tables, against their SQL where there is some."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tripmart.llm import oracle, queries
from tripmart.llm.mixing import mix_sources

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the given tables")


def test_every_operator_is_registered():
    names = set(queries.all_queries())
    assert {n.split("_")[0] for n in names} == {f"op{k}" for k in range(1, 14)} | {"pipeline"}
    assert names <= set(entry_point.queries()) and set(oracle.statements()) <= names


def connected():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_query_equals_sql(spark, name):
    assert_equal(queries.all_queries()[name](spark, FOLDER), connected().sql(oracle.statements()[name]))


@pytest.mark.parametrize("shard_words", [1000, 60])
def test_mix_of_many_shards_equals_sql(spark, shard_words):
    con = connected()
    docs = queries.table(spark, FOLDER, "documents")
    assert_equal(mix_sources(docs, shard_words=shard_words).drop("source"), con.sql(oracle.source_mix(shard_words)))


def assert_equal(df, want):
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == sorted(want.select(*columns).fetchall(), key=repr)
