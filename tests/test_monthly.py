"""Quantiles from stored months."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientela.operators import monthly
from clientela.sources.staging import staged

ROWS = "Periodo string, g string, x double, y double"
PS = (0.0, 0.1, 0.5, 0.9, 1.0)


@pytest.fixture(scope="module")
def small_slices():
    held = monthly.SLICES, monthly.RUNS
    monthly.SLICES, monthly.RUNS = 64, 16
    yield
    monthly.SLICES, monthly.RUNS = held


def month(name, n, seed):
    r = random.Random(seed)
    shift = 100 * seed  # months that hardly overlap, and one value that a third of all rows hold
    draw = lambda: r.choice([7.0, None, r.gauss(shift, 50), float(r.randint(0, 5))])
    return [(name, r.choice(["a", "a", "a", "b", None]), draw(), draw()) for _ in range(n)]


def quantiles(rows, ps):
    want = {}
    for i, c in ((2, "x"), (3, "y")):
        for g in "ab":
            held = [r[i] for r in rows if r[1] == g and r[i] is not None]
            want |= {(g, c, p): (len(held), float(np.quantile(held, p))) for p in ps if held}
    return want


def found(df):
    return {(r.g, r.columna, r.p): (r.n, r.valor) for r in df.collect()}


def test_all_months_and_a_repeated_one(spark, make, tmp_path, small_slices):
    folder = str(tmp_path)
    months = {f"2024-{m:02d}": month(f"2024-{m:02d}", 400, m) for m in (1, 2, 3)}
    wrong = month("2024-02", 900, 9)
    for rows in (months["2024-01"], wrong, months["2024-02"], months["2024-03"]):
        monthly.store_months(monthly.month_values(make(rows, ROWS), ["x", "y"], ["g"]), folder)
    values, slices = monthly.stored_months(spark, folder)
    got = found(monthly.quantiles_of_months(values, slices, PS, ["g"]))
    want = quantiles(sum(months.values(), []), PS)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9)
    two = F.col("Periodo") != "2024-03"
    some = found(monthly.quantiles_of_months(values.where(two), slices.where(two), PS, ["g"]))
    for k, (n, v) in quantiles(months["2024-01"] + months["2024-02"], PS).items():
        assert some[k][0] == n and some[k][1] == pytest.approx(v, abs=1e-9)


def test_old_months_are_read_in_part(spark, make, tmp_path, small_slices):
    """The folders of months and runs of slices are pruned at run time: few stored rows are read."""
    folder = str(tmp_path)
    rows = [(f"2024-{m:02d}", "a", float(100_000 * m + i), None) for m in (1, 2, 3) for i in range(4_000)]
    monthly.store_months(monthly.month_values(make(rows, ROWS), ["x", "y"], ["g"]), folder)
    values, slices = monthly.stored_months(spark, folder)
    df = monthly.quantiles_of_months(values, slices, (0.5,), ["g"])
    assert [r.valor for r in df.collect()] == [201_999.5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    read = spark.read.parquet(f"{folder}/values").where("Periodo = '2024-02' AND tramo = 8").count()
    assert 0 < read < 600


def test_constant_and_empty(spark, make, tmp_path, small_slices):
    folder = str(tmp_path)
    monthly.store_months(monthly.month_values(make([("2024-01", "a", 3.0, None)] * 50, ROWS), ["x", "y"], ["g"]), folder)
    values, slices = monthly.stored_months(spark, folder)
    assert found(monthly.quantiles_of_months(values, slices, PS, ["g"])) == {("a", "x", p): (50, 3.0) for p in PS}
    none = monthly.quantiles_of_months(values.limit(0), slices.limit(0), PS, ["g"])
    assert none.count() == 0


def test_a_month_is_written_from_its_own_rows(spark, make, tmp_path, small_slices, monkeypatch):
    """What is stored between lies in a folder for each month, and slices are found by compiled code."""
    held = {}

    def spy(df, name, *more, **named):
        held[name] = staged(df, name, *more, **named)
        return held[name]

    monkeypatch.setattr(monthly, "staged", spy)
    rows = [(f"2024-{m:02d}", "a", float(i), float(-i)) for m in (1, 2) for i in range(200)]
    values = monthly.month_values(make(rows, ROWS), ["x", "y"], ["g"])
    assert not re.search("lambdafunction", values._jdf.queryExecution().executedPlan().toString())
    monthly.store_months(values, str(tmp_path))
    mine = held["months"].where("Periodo = '2024-02'")
    files = held["months"].inputFiles()
    assert files and all("Periodo=2024-0" in f for f in files)
    assert "PartitionFilters: [isnotnull(Periodo" in mine._jdf.queryExecution().executedPlan().toString()
    assert held["months"].columns == values.columns and mine.agg(F.sum("veces")).first()[0] == 400
