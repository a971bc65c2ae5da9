"""Every registered query against its SQL on the smallest benchmark tables."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import SparkSession

import __spark_entry__ as entry
from loomfeed.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in plan
    ours = Counter(tuple(r) for r in frame.select(*columns).collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    theirs = Counter(tuple(r[names.index(c)] for c in columns) for r in result.fetchall())
    assert ours == theirs


def test_entry(spark: SparkSession):
    assert entry.entry(spark).columns == [
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        "n_name",
    ]
