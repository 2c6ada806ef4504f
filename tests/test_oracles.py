"""Every registered query against its SQL on the smallest driver tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def cell(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return "null"
    if isinstance(value, (pd.Timestamp,)) or hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, (str, bool)) or type(value).__name__ == "bool_":
        return str(value)
    number = float(value)
    return "null" if math.isnan(number) else repr(number + 0.0)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    got = driver.queries()[name](spark, DATA).toPandas()
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = duck.execute(sql).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert rows(got) == rows(want)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and "cluster_patrones_consumo" in df.columns


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
