"""Tables stored by month and by bucket, and modes by candidates."""

import re
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from clientela.operators import features, profile, relational
from clientela.sources import buckets, months
from tests.test_carried import LINES, close, random_lines

ROWS = "Periodo string, id long"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def history(make, folder):
    df = make([(m, i) for i, m in enumerate([None, None, "2024-01", "2024-01", "2024-02", "2024-03", "a/b=c"])], ROWS)
    months.store_by_month(df, folder)
    return df


@pytest.mark.parametrize("new", [[("2024-02", 10)], [(None, 11)], [("2024-02", 12), (None, 13), ("2025-01", 14)], [], [("a/b=c", 15)]])
def test_upsert_of_stored_months(spark, make, tmp_path, new):
    folder = str(tmp_path / "h")
    df = history(make, folder)
    current = make(new, ROWS)
    table = months.stored_table(spark, folder, df.schema)
    got = months.upsert_months(table, folder, current)
    want = relational.upsert_period(df, current)
    assert sorted(map(str, got.select("Periodo", "id").collect())) == sorted(map(str, want.select("Periodo", "id").collect()))


def test_only_other_months_are_read(spark, make, tmp_path):
    folder = str(tmp_path / "h")
    df = history(make, folder)
    got = months.upsert_months(months.stored_table(spark, folder, df.schema), folder, make([("2024-02", 10)], ROWS))
    got.collect()
    assert "dynamicpruning" in plan(got)
    # A file that the upsert must not open: it breaks whoever reads it.
    for f in (tmp_path / "h" / "Periodo=2024-02").glob("*.parquet"):
        f.write_bytes(b"not parquet")
    for f in (tmp_path / "h" / "Periodo=2024-02").glob(".*.crc"):
        f.unlink()
    again = months.upsert_months(months.stored_table(spark, folder, df.schema), folder, make([("2024-02", 10)], ROWS))
    assert sorted(r.id for r in again.collect()) == [0, 1, 2, 3, 5, 6, 10]


def test_latest_month(spark, make, tmp_path):
    folder = str(tmp_path / "h")
    df = history(make, folder).where("Periodo < 'a'")
    months.store_by_month(df, str(tmp_path / "g"))
    table = months.stored_table(spark, str(tmp_path / "g"), df.schema)
    got = months.of_months(table, months.latest_month(spark, str(tmp_path / "g")))
    assert [r.id for r in got.collect()] == [5]


def put(spark, df, folder, key, hot):
    return buckets.store_bucketed(df, f"t{uuid.uuid4().hex}", folder, key, 4, hot)


@pytest.mark.parametrize("hot_rows", [1, 5, 1000])
def test_profile_of_buckets(spark, make, tmp_path, hot_rows):
    lines = make([r for m in (1, 2) for r in random_lines(m, 40, m)], LINES).na.drop(subset=["mail", "fecha", "total_actualizado"])
    held = put(spark, lines, str(tmp_path), "mail", buckets.hot_keys(lines, "mail", hot_rows))
    assert close(buckets.per_key(features.customer_profile, held)) == close(features.customer_profile(lines))
    assert "Exchange" not in plan(features.customer_profile(held.even))
    sizes = Counter(r.mail for r in held.even.collect())
    assert not sizes or max(sizes.values()) <= hot_rows


def test_buckets_grow_with_the_table(spark, monkeypatch):
    counts = buckets.key_rows(spark.range(1_000).selectExpr("if(id < 10, null, id DIV 30) AS k"), "k")
    assert buckets.bucket_number(counts, 8) == 8
    monkeypatch.setattr(buckets, "BUCKET_ROWS", 30)
    assert buckets.bucket_number(counts, 8) == 34
    assert {r[0] for r in buckets.hot_keys(counts, "k", 29).collect()} == set(range(1, 33))


def test_join_of_buckets(spark, make, tmp_path):
    bills = make([(i, f"b{i}") for i in range(20)] + [(None, "n")], "bill_id long, name string")
    items = make([(i % 25, i) for i in range(100)] + [(3, 100 + i) for i in range(50)] + [(None, 999)], "bill_id long, item long")
    hot = buckets.hot_keys(items, "bill_id", 20)
    a, b = put(spark, items, str(tmp_path / "a"), "bill_id", hot), put(spark, bills, str(tmp_path / "b"), "bill_id", hot)
    join = lambda x, y: x.join(y.hint("merge"), "bill_id")
    assert close(buckets.per_key(join, a, b)) == close(items.join(bills, "bill_id"))
    text = plan(join(a.even, b.even))
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert {r.bill_id for r in a.spread.collect()} == {3, None} == {r.bill_id for r in b.spread.collect()}


def test_modes(spark, make):
    rows = [(i, "x" if i % 3 else "y", i % 2, None) for i in range(300)] + [(None, None, None, None)]
    got = {r.columna: r[1:] for r in profile.modes(make(rows, "a long, b string, c long, d string"), ["a", "b", "c", "d"]).collect()}
    assert got == {"a": (300, "0", 1), "b": (300, "x", 200), "c": (300, "0", 150)}


def test_modes_of_many_values(spark, make, monkeypatch):
    """More values than counters: decided where one is frequent, else counted in full."""
    monkeypatch.setattr(profile, "CANDIDATES", 4)
    monkeypatch.setattr(profile, "COUNTERS", 64)
    monkeypatch.setattr(profile, "MODE_ERROR", 3.5 / 64)
    df = spark.range(3000).selectExpr("if(id % 5 = 0, 'hot', concat('v', id)) AS a", "concat('w', id) AS b", "concat('u', id div 2) AS c")
    got = {r.columna: r[1:] for r in profile.modes(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (3000, "hot", 600), "b": (3000, "w0", 1), "c": (3000, "u0", 2)}
    decided = profile.modes(df, ["a"])
    assert "Exchange" not in plan(decided)  # read from what is stored; nothing is counted in full
