"""Edge rows of the scalar rules."""

import pytest
from pyspark.sql import functions as F

from clientela.functions import scalars as S


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_pack_units_last_rule_wins(make):
    df = make([("a 10 20", 1), ("2012", 1), ("10", 1), ("Box 20", 2), (None, 1), ("x", 1)],
              "t string, k int")
    assert column(df, S.pack_units(F.col("t"), F.col("k"))) == [20, 12, 10, 1, 1, 1]
    assert column(df, S.pack_units(F.col("t"), F.col("k"), None)) == [20, 12, 10, 1, None, None]


def test_presentation(make):
    df = make([("BOX", 1), ("bOx", 1), ("box", 1), ("Box", 2), (None, 1), (None, 2)], "t string, k int")
    late = ["Box", "Soft_pack", "Box", "Otros Productos", "Soft_pack", "Otros Productos"]
    assert column(df, S.presentation(F.col("t"), F.col("k"))) == late
    assert column(df, S.presentation(F.col("t"), F.col("k"), None))[4] is None


def test_combo(make):
    df = make([(1,), (9,), (10,), (11,), (15,), (45,), (46,), (-3,), (0,)], "q int")
    assert column(df, S.combo_flag(F.col("q"))) == [0, 1, 0, 1, 0, 0, 0, 1, 1]
    assert column(df, S.combo_flag(F.col("q"), exclude_one=False))[0] == 1


def test_cartons_and_unit_price_without_division_by_zero(make):
    df = make([(20, 10, 5.0), (3, 0, 5.0), (0, 1, 5.0)], "q int, s int, t double")
    assert column(df, S.carton_count(F.col("q"), F.col("s"))) == [2.0, 0.0, 0.0]
    assert column(df, S.unit_price(F.col("t"), F.col("q"))) == [0.25, 5.0 / 3, 0.0]


def test_carton_size_rules(make):
    df = make([(1, "Fino Box 20"), (2, "x"), (1, "x"), (None, "x"), (2, "Fino Box 20"), (1, None)],
              "k int, t string")
    assert column(df, S.carton_size(F.col("k"), F.col("t"), "Fino Box 20")) == [15, 1, 10, 10, 15, 10]
    assert column(df, S.carton_size(F.col("k"), F.col("t"), "Fino Box 20", exact=True)) == [15, 0, 10, 0, 15, 10]


def test_gap_bounds(make):
    df = make([(None,), (0,), (30,), (31,), (90,), (91,), (183,), (184,)], "d int")
    assert column(df, S.gap_bucket(F.col("d"))) == [
        "Primera / Única Compra", "Gap Corto", "Gap Corto", "Gap Medio", "Gap Medio", "Gap Largo",
        "Gap Largo", "Gap Muy Largo"]


def test_clean_title(make):
    df = make([("A amp; B",), (None,), ("A.mp;",)], "t string")
    assert column(df, S.clean_title(F.col("t"))) == ["A  B", None, "A.mp;"]


def test_coercions(make):
    df = make([("12",), ("12.7",), ("x",), (None,), ("NaN",)], "t string")
    assert column(df, S.coerce_int(F.col("t"), -1)) == [12, 12, -1, -1, -1]
    assert column(df, S.coerce_double(F.col("t"))) == [12.0, 12.7, None, None, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        column(df, S.coerce_int(F.col("t"), strict=True))


def test_snapshot_dates_of_all_forms(make):
    df = make([("2024-09",), ("2024-11-01",), ("2024-11-01 10:00:00",), ("?",)], "t string")
    assert [str(d) for d in column(df, S.snapshot_date(F.col("t")))] == [
        "2024-09-01", "2024-11-01", "2024-11-01", "None"]


def test_calendar_at_year_start(make):
    df = make([("2025-01-01",), ("2025-02-15",)], "d date")
    cal = S.run_calendar(F.col("d"))
    got = [tuple(map(str, r)) for r in df.select(*cal.values()).collect()]
    assert got[0] == ("2024-12-31", "2024-12", "DIC_2024", "2024-11", "NOV_2024")
    assert got[1][1:] == ("2025-02", "FEB_2025", "2025-01", "ENE_2025")


def test_elapsed_days_are_whole_periods(make):
    df = make([("2024-01-01 12:00:00", "2024-01-03 06:00:00"), ("2024-01-01 00:00:00", "2024-01-02 00:00:00"),
               ("2024-01-01 00:00:00", "2024-01-01 23:59:00")], "a timestamp_ntz, b timestamp_ntz")
    assert column(df, S.elapsed_days(F.col("a"), F.col("b"))) == [1, 1, 0]


def test_half_even(make):
    df = make([(0.125,), (0.375,), (2.5,)], "x double")
    assert column(df, S.round_money(F.col("x"))) == [0.12, 0.38, 2.5]


def test_rules_work_on_a_stream(spark, make, tmp_path):
    make([("Box 20", 1, 7)], "t string, k int, q int").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t string, k int, q int").parquet(str(tmp_path / "in"))
    out = stream.select(S.pack_units(F.col("t"), F.col("k")).alias("u"), S.combo_flag(F.col("q")).alias("c"))
    query = out.writeStream.format("memory").queryName("rules").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert [tuple(r) for r in spark.sql("SELECT * FROM rules").collect()] == [(20, 1)]
