"""Every named query against its SQL in another engine, at the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from sedimenta.plans import suites

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "tzinfo") and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    return value


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_oracles_name_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(suites.load().QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    names = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "ExternalRDD"):
        assert operator not in plan
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = duck.execute(sql)
    order = [d[0] for d in cursor.description]
    assert sorted(order) == names
    at = [order.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    assert got == want
