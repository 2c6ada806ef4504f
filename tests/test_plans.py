"""Shape of the physical plans."""

import os
import re

import pytest

import __spark_entry__ as driver
from workload import base

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_no_python_and_no_global_window(spark, name):
    text = plan(driver.queries()[name](spark, DATA))
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", text)
    for window in re.findall(r"windowspecdefinition\(([^)]*)", text):
        assert not re.match(r"\S+ (ASC|DESC)", window), f"window without partition: {window}"
    assert "CartesianProduct" not in text


def test_month_filter_reaches_the_scan(spark):
    text = plan(driver.queries()["orders_in_month"](spark, DATA))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_columns_are_pruned(spark):
    text = plan(driver.queries()["rfm"](spark, DATA))
    schema = re.search(r"ReadSchema: struct<(l_[^>]*)", text).group(1)
    assert set(re.findall(r"l_\w+", schema)) == {"l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate"}


def test_netting_without_hot_orders_is_one_window(spark):
    df = driver.queries()["net_credit_notes"](spark, DATA)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert final.count("Window [") == 1 and "SortMergeJoin" not in final


@pytest.mark.parametrize("name", ["rfm", "rfm_rounded"])
def test_recency_shares_the_aggregation(spark, name):
    df = driver.queries()[name](spark, DATA)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 1
    assert "ReusedExchange" in final


@pytest.mark.parametrize("few", [10**9, 1_000, 10])
def test_lines_of_a_large_table_are_dealt_by_its_rows(spark, monkeypatch, few):
    want = base.sale_lines(spark, DATA)
    assert "REPARTITION_BY_NUM" not in plan(want)
    monkeypatch.setattr(base, "FEW_ROWS", few)
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    got = base.sale_lines(spark, DATA)
    rows = base.table(spark, DATA, "lineitem").count()
    dealt = re.findall(r"hashpartitioning\(\w+#\d+L, (\d+)\), REPARTITION_BY_NUM", plan(got))
    assert dealt == [str(rows // 500 + 1)] * {10**9: 0, 1_000: 2, 10: 4}[few]
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
