"""Features, prices, history, files and jobs."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela import contracts as C
from clientela.operators import features, lines, pricing, relational
from clientela.plans import jobs
from clientela.sources import files, tables

FEAT = "mail string, bill_id long, tipo_prd_id int, MARCA string, `CATEGORÍA` string, Combo int, Presentacion string"
ROWS = [
    ("only_other", 1, 2, "A", "FF", 0, "Otros Productos"),
    ("one_brand", 2, 1, "A", "FF", 1, "Box"), ("one_brand", 3, 1, "A", "FF", 0, "Soft_pack"),
    ("two_brands", 4, 1, "A", "FF", 0, "Box"), ("two_brands", 5, 1, "B", None, 0, "Box"),
    ("mixed", 6, 1, "A", "FF", 0, "Box"), ("mixed", 6, 1, "B", "FF", 0, "Box"),
    ("no_brand", 7, 1, None, "FF", 0, "Box"), ("brand_gap", 8, 1, None, "FF", 0, "Box"),
    ("brand_gap", 9, 1, "A", "FF", 0, "Box"), (None, 10, 1, "A", "FF", 0, "Box"),
]


def test_features(make):
    got = {r.mail: r for r in features.customer_features(make(ROWS, FEAT)).collect()}
    assert set(got) == {r[0] for r in ROWS if r[0]}
    assert {m: r.Multimarca for m, r in got.items()} == {
        "only_other": 0, "one_brand": 0, "two_brands": 1, "mixed": 1, "no_brand": 0, "brand_gap": 0}
    assert {m for m, r in got.items() if r.mezcla_en_misma_compra} == {"mixed"}
    assert got["two_brands"].FF == 0 and got["two_brands"].cluster_patrones_consumo == "No FF - Multimarca"
    assert (got["one_brand"].box, got["one_brand"].soft_pack, got["one_brand"].consume_combo) == (1, 1, 1)
    assert got["only_other"].otros_productos == 1


def test_features_of_the_first_rules(make):
    got = {r.mail: r.Multimarca for r in features.customer_features(make(ROWS, FEAT), True).collect()}
    assert got == {"only_other": 1, "one_brand": 0, "two_brands": 1, "mixed": 1, "no_brand": 0, "brand_gap": 1}


def test_mixing_agrees_with_the_fused_flag(make):
    df = make(ROWS, FEAT)
    assert [r.mail for r in features.mixing_customers(df).collect()] == ["mixed"]


def test_returns(make):
    df = make([("sale", 0), ("sale", -1), (None, 2), (C.CREDIT_NOTE, 3)], "type string, quantity int")
    assert [tuple(r) for r in relational.drop_returns(df).collect()] == [(None, 2)]
    assert relational.drop_returns(df, positive_only=False).count() == 2


def test_active_customers(make):
    df = make([("a", "2023-01-01 00:00:00"), ("a", "2024-06-01 00:00:00"), ("b", "2023-01-01 00:00:00"),
               ("c", "2024-01-01 00:00:00"), ("a", None)], "mail string, fecha timestamp_ntz")
    got = relational.active_customers(df, "2024-12-31").collect()
    assert sorted(r.mail for r in got) == ["a", "a", "c"]


PRICE = "product_id long, fecha timestamp_ntz, precio decimal(18,2)"


def test_latest_price(make):
    log = make([(1, "2024-01-01 00:00:00", 5), (1, "2024-01-02 00:00:00", 6), (2, "2024-01-01 00:00:00", 3),
                (2, "2024-01-02 00:00:00", None), (3, "2024-01-01 00:00:00", 1), (3, "2024-01-01 00:00:00", 2)], PRICE)
    assert {r.product_id: float(r.precio) for r in pricing.latest_price(log).collect()} == {1: 6.0, 3: 2.0}


HIST = "product_id long, quantity int, total_actualizado double, bill_id long, fecha timestamp_ntz"


def test_basket_index_and_repricing(make):
    now = make([(1, 10, 0.0, 9, None), (2, 5, 0.0, 9, None), (3, 1, 0.0, 9, None)], HIST)
    prices = make([(1, None, 20), (2, None, 6)], PRICE)
    old = make([(1, 2, 20.0, 1, "2024-01-01 00:00:00"), (1, 1, 99.0, 2, "2024-02-01 00:00:00"),
                (4, 2, 10.0, 3, "2024-01-01 00:00:00"), (4, 0, 10.0, 4, "2024-01-01 00:00:00")], HIST)
    row = pricing.basket_index(now, prices, old, k=2).first()
    assert (row.canasta_nueva, row.canasta_vieja, row.indice) == (26.0, 10.0, 2.6)
    assert pricing.basket_index(now, prices, old, k=2, matched=True).first().indice == 2.0
    index = pricing.basket_index(now, prices, old, k=2)
    stale = old.withColumn("precio", F.lit(1.0))
    got = {r.bill_id: r.total_actualizado for r in pricing.reprice_history(stale, prices, index).collect()}
    assert got == {1: 40.0, 2: 20.0, 3: 26.0, 4: 0.0}
    assert pricing.basket_index(now, prices, old.limit(0), k=2).first().indice == 1.0


def test_upsert_twice_is_once(make):
    old = make([("2024-01", 1), ("2024-02", 2)], "Periodo string, x int")
    new = make([("2024-02", 3), ("2024-02", 4)], "Periodo string, x int")
    for period in (None, "2024-02"):
        once = relational.upsert_period(old, new, period=period)
        twice = relational.upsert_period(once, new, period=period)
        assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [
            ("2024-01", 1), ("2024-02", 3), ("2024-02", 4)]


def test_append_with_unequal_columns(make):
    a, b = make([(1, "x")], "p int, q string"), make([(2, "y")], "p int, r string")
    assert sorted(map(tuple, relational.append_history(a, b).collect())) == [(1, "x", None), (2, None, "y")]
    with pytest.raises(ValueError):
        relational.with_history(None, None)


def test_catalogue_never_fans_out(make):
    df = make([("A amp;B",), ("C",), (None,)], "titulo string")
    catalog = make([("A B", "m2", "FF"), ("A B", "m1", "FF")], "titulo string, MARCA string, `CATEGORÍA` string")
    got = {r.titulo: (r.MARCA, r["CATEGORÍA"]) for r in lines.enrich_catalog(df, catalog).collect()}
    assert got == {"A B": ("m1", "FF"), "C": ("otros", "otros"), None: ("otros", "otros")}


def test_csv_by_name_with_index_column(spark, make, tmp_path):
    path = str(tmp_path / "old.csv")
    with open(path, "w") as f:
        f.write('Unnamed: 0,total,mail,fecha\n0,1.50,a,2024-01-01 10:00:00\n1,x,"b,""c""",\n')
    schema = T.StructType([T.StructField("mail", T.StringType()), T.StructField("total", T.DoubleType()),
                           T.StructField("fecha", T.TimestampNTZType()), T.StructField("nuevo", T.IntegerType())])
    rows = [tuple(map(str, r)) for r in files.read_csv_snapshot(spark, path, schema, foreign=True).collect()]
    assert rows == [("a", "1.5", "2024-01-01 10:00:00", "None"), ('b,"c"', "None", "None", "None")]
    assert files.read_csv_snapshot(spark, path, foreign=True).columns == ["total", "mail", "fecha"]


TEXTS = [(1, "a\nb"), (2, " lead"), (3, "trail "), (4, ""), (5, None), (6, 'q"u"o,t;e\t'), (7, "\r\n"), (8, r"\N"),
         (9, "\\n \\\\ \\"), (10, "é 日"), (11, '"'), (12, "\\\n")]


@pytest.mark.parametrize("sep", [",", "\t", ";"])
def test_csv_keeps_every_text(spark, tmp_path, sep):
    df = spark.createDataFrame(TEXTS, "id long, t string")
    path = str(tmp_path / "texts")
    files.write_snapshot(df.repartition(3), path, sep=sep)
    assert sorted(map(tuple, files.read_csv_snapshot(spark, path, df.schema, sep).collect())) == TEXTS


def test_foreign_csv_with_line_breaks(spark, tmp_path):
    path = str(tmp_path / "foreign.csv")
    with open(path, "w") as f:
        f.write('id,t\n1,"a\nb"\n2, c \n3,\n')
    got = files.read_csv_snapshot(spark, path, foreign=True).collect()
    assert [tuple(r) for r in got] == [("1", "a\nb"), ("2", " c "), ("3", None)]


def test_labels_that_are_gone_leave_no_folder(spark, make, tmp_path):
    path = str(tmp_path / "seg")
    for label in ("x", "y"):
        files.write_by_segment(make([("a", label)], "mail string, rfm string"), path)
    assert [p.name for p in (tmp_path / "seg").iterdir() if p.is_dir()] == ["rfm=y"]


def test_partition_overwrite_touches_only_its_period(spark, make, tmp_path):
    path = str(tmp_path / "hist")
    files.write_snapshot(make([("2024-01", 1), ("2024-02", 2)], "Periodo string, x int"), path, "parquet", partition="Periodo")
    files.write_snapshot(make([("2024-02", 3)], "Periodo string, x int"), path, "parquet", partition="Periodo")
    got = spark.read.schema("x int, Periodo string").parquet(path)
    assert sorted((r.Periodo, r.x) for r in got.collect()) == [("2024-01", 1), ("2024-02", 3)]


def test_segment_folders(spark, make, tmp_path):
    path = str(tmp_path / "seg")
    files.write_by_segment(make([("a", C.LOYAL), ("b", C.AT_RISK), ("c", None)], "mail string, rfm string"), path)
    assert sorted(p.name for p in (tmp_path / "seg").iterdir() if p.is_dir()) == ["rfm=en peligro", "rfm=fidelizado"]


def test_jdbc_options_per_table():
    got = tables.shop_sources({"url": "u"})
    assert got["prices"] == {"url": "u", "dbtable": C.SHOP_TABLES["prices"]}


def test_active_profile_counts_unvalued_lines_as_activity(make):
    ddl = FEAT + ", fecha timestamp_ntz, total_actualizado double"
    row = lambda mail, day, total: (mail, 1, 1, "A", "FF", 0, "Box", f"{day} 00:00:00", total)
    df = make([row("old", "2022-01-01", 1), row("new", "2024-06-01", 2), row("half", "2022-02-01", 3),
               row("half", "2024-06-05", None), row("bare", "2024-06-06", None)], ddl)
    got = {r.mail: (r.ValorMonetario, str(r.ultima_compra), r.Recencia)
           for r in features.with_recency(jobs.active_profile(df, "2024-12-31")).collect()}
    assert got == {"new": (2.0, "2024-06-01 00:00:00", 0), "half": (3.0, "2022-02-01 00:00:00", 851)}


def test_history_renames_legacy_labels_and_replaces_the_date(make):
    old = make([("a", "estrella", "2024-08", "2024-08-01 00:00:00"), ("a", "perdido", "2024-09-01", "2024-08-15 00:00:00")],
               "mail string, rfm string, fecha_segmentacion string, ultima_compra timestamp_ntz")
    now = make([("a", "en peligro", "2024-09-01", "2024-09-10 00:00:00")],
               "mail string, rfm string, fecha_segmentacion date, ultima_compra timestamp_ntz")
    rows = sorted(jobs.segmentation_history(now, old).collect(), key=lambda r: r.fecha_segmentacion)
    assert [(r.rfm, r.gap_entre_compras, r.segmento_gap) for r in rows] == [
        ("fidelizado", None, C.GAP_FIRST), ("en peligro", 40, "Gap Medio")]


def test_lookup_of_an_unknown_customer(make):
    df = make([("a", 3)], "mail string, Recencia int")
    assert tuple(relational.customer_lookup(df, "a").first()) == ("a", 3, True)
    assert tuple(relational.customer_lookup(df, "z").first()) == ("z", None, False)


DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
def test_monthly_run_can_be_repeated(spark, tmp_path):
    """Two months in a row; the second again gives the same tables, equal to the operators' own."""
    from workload.base import catalog, shop
    tables, titles = shop(spark, DATA), catalog(spark, DATA)
    rules = jobs.Rules(special="Box 20", method="lloyd")
    run = lambda day, first=False: jobs.run_month(tables, titles, day, str(tmp_path), first, rules)
    read = lambda p: sorted(map(str, spark.read.parquet(p).collect()))
    run("1998-04-01", True)
    paths = run("1998-05-01")
    once = {name: read(paths[name]) for name in ("lines", "history", "snapshot", "snapshots")}
    latest = sorted(p.name for p in (tmp_path / "segments").iterdir() if p.is_dir())
    paths = run("1998-05-01")
    assert {name: read(paths[name]) for name in once} == once
    assert sorted(p.name for p in (tmp_path / "segments").iterdir() if p.is_dir()) == latest
    assert once["lines"] == sorted(map(str, jobs.monthly_lines(tables, titles, "1998-04", rules=rules).collect()))
    schema = spark.read.parquet(paths["snapshots"]).schema
    current = spark.read.parquet(paths["snapshots"]).where("fecha_segmentacion = '1998-04-01'")
    now = sorted(map(str, current.collect()))
    assert 0 < len(now) < len(once["snapshots"]) and read(paths["current"]) == now
    assert paths["latest"] == files.published(spark, str(tmp_path / "latest"))
    assert sorted(map(str, files.read_csv_snapshot(spark, paths["latest"], schema).collect())) == now


def entries(spark):
    from pathlib import Path
    from clientela.sources.staging import staging_root
    root = Path(staging_root(spark).removeprefix("file:"))
    return {p.name for p in root.iterdir()} if root.is_dir() else set()


def test_hand_offs_of_a_job_go_when_it_ends(spark):
    from clientela.sources.staging import owned, staged
    before = entries(spark)
    with owned(spark):
        first = staged(spark.range(3), "first")
        with owned(spark):
            second = staged(first, "second")
        assert second.count() == 3 and len(entries(spark) - before) == 1  # the outer job owns both
    assert entries(spark) == before
    with pytest.raises(RuntimeError, match="broken"), owned(spark):
        staged(spark.range(3), "third")
        raise RuntimeError("broken")
    assert entries(spark) == before
    staged(spark.range(3), "free")  # nobody owns it
    assert len(entries(spark) - before) == 1


@pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")
def test_the_monthly_run_leaves_no_hand_offs(spark, tmp_path):
    from workload.base import catalog, shop
    before = entries(spark)
    paths = jobs.run_month(shop(spark, DATA), catalog(spark, DATA), "1998-04-01", str(tmp_path), True, jobs.Rules(method="lloyd"))
    assert entries(spark) == before and spark.read.parquet(paths["current"]).count() > 0


def test_a_broken_publication_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path / "latest")
    with pytest.raises(FileNotFoundError):
        files.published(spark, root)
    rows = lambda: sorted(r.v for r in spark.read.parquet(files.published(spark, root)).collect())
    files.publish(spark.range(5).selectExpr("id AS v"), root, "parquet")
    half = spark.range(0, 40, 1, 4).selectExpr("CASE WHEN id < 39 THEN id ELSE CAST(raise_error('lost') AS BIGINT) END AS v")
    with pytest.raises(Exception, match="lost"):
        files.publish(half, root, "parquet")
    assert rows() == list(range(5))
    reader = spark.read.parquet(files.published(spark, root))
    files.publish(spark.range(7).selectExpr("id AS v"), root, "parquet")
    assert rows() == list(range(7)) and reader.count() == 5  # who resolved before reads on
    for n in (8, 9):
        files.publish(spark.range(n).selectExpr("id AS v"), root, "parquet")
    names = sorted(p.name for p in (tmp_path / "latest").iterdir() if not p.name.startswith("."))
    assert rows() == list(range(9)) and len(names) == 4 and sum(n.startswith("_current-") for n in names) == 2
