"""Order-dependent operators against their sequential definition."""

import random
import re

import pytest
from pyspark.sql import functions as F

from clientela.operators import gaps, lines, ordered, snapshot, transitions
from clientela.sources import staging

NOTE = "pmi-credit-note"
LINE = "post_id long, titulo_descripcion string, product_id long, fecha timestamp_ntz, quantity int, type string, bill_id long"


def literal_netting(rows):
    """Walk the sorted rows; a note after a row of its order and product reduces that row."""
    key = lambda r: (r[0], r[1] is None, r[1] or "", r[3], r[6], r[4])
    rows = sorted(rows, key=key)
    out = [list(r) for r in rows]
    for i in range(1, len(rows)):
        a, b = rows[i - 1], rows[i]
        if b[5] == NOTE and a[2] == b[2] and a[0] == b[0] and b[3] > a[3]:
            out[i - 1][4] = a[4] - b[4]
    return sorted(map(tuple, out), key=str)


def as_rows(df):
    return sorted([(r.post_id, r.titulo_descripcion, r.product_id, str(r.fecha), r.quantity, r.type, r.bill_id)
                   for r in df.collect()], key=str)


EDGES = [
    (1, "a", 1, "2024-01-01 00:00:00", 5, NOTE, 1),      # a note comes first
    (2, "a", 1, "2024-01-01 00:00:00", 5, "sale", 2), (2, "a", 1, "2024-01-01 00:00:00", 2, NOTE, 3),
    (3, "a", 1, "2024-01-01 00:00:00", 5, "sale", 4), (3, "a", 1, "2024-01-02 00:00:00", 2, NOTE, 5),
    (4, "a", 1, "2024-01-01 00:00:00", 5, "sale", 6), (4, "a", 1, "2024-01-02 00:00:00", 2, NOTE, 7),
    (4, "a", 1, "2024-01-03 00:00:00", 1, NOTE, 8),      # two notes: the second nets the first
    (5, "a", 1, "2024-01-01 00:00:00", 5, "sale", 9), (5, "b", 2, "2024-01-02 00:00:00", 2, NOTE, 10),
    (6, None, 1, "2024-01-01 00:00:00", 5, "sale", 11), (6, None, 1, "2024-03-02 00:00:00", 2, NOTE, 12),
]


@pytest.mark.parametrize("hot_rows", [10**6, 0])
def test_netting(make, hot_rows):
    rng = random.Random(7)
    rows = list(EDGES)
    for n in range(400):
        product = rng.randint(1, 4)
        rows.append((rng.choice([100, 100, 101, 102]), f"p{product}", product,
                     f"2024-0{rng.randint(1, 3)}-{rng.randint(10, 28)} {rng.randint(10, 12)}:00:00",
                     rng.randint(1, 30), rng.choice(["sale", NOTE]), 1000 + n))
    got = lines.net_credit_notes(make(rows, LINE), hot_rows=hot_rows)
    assert as_rows(got) == literal_netting(rows)


@pytest.mark.parametrize("hot_rows", [10**6, 0])
@pytest.mark.parametrize("forward", [False, True])
def test_neighbour_of_one_hot_key(make, hot_rows, forward):
    rng = random.Random(3)
    rows = [("hot" if n % 3 else f"k{n}", f"2024-{rng.randint(1, 9):02d}-10 00:00:00", n) for n in range(300)]
    df = make(rows, "k string, t timestamp_ntz, n int")
    got = {r.n: r.p.n if r.p else None for r in ordered.neighbour(
        df, ["k"], ["t", "n"], ["n"], "p", forward=forward, hot_rows=hot_rows).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        group = [r[2] for r in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))]
        for i, n in enumerate(group):
            j = i + 1 if forward else i - 1
            want[n] = group[j] if 0 <= j < len(group) else None
    assert got == want


def test_all_hot_keys_are_found(spark):
    df = spark.range(3_000 * 4).selectExpr("concat('k', id % 3000) AS k").union(
        spark.range(500).selectExpr("concat('few', id) AS k"))
    hot = ordered.hot_keys(df, ["k"], rows=3).collect()
    assert len(hot) == 3_000 and {r["_rows"] for r in hot} == {4}


def test_pieces_hold_many_small_keys(spark, monkeypatch):
    """Also where every key counts as hot, rows make as many pieces as their number asks for."""
    monkeypatch.setattr(ordered, "staged", lambda df, name: kept.setdefault(name, df.localCheckpoint()))
    df = spark.range(30_000).selectExpr("id DIV 4 AS k", "CAST('2024-01-01' AS TIMESTAMP_NTZ) AS t", "id AS n")
    for rows, most in ((ordered.PIECE_ROWS, 4), (2_000, 16)):
        kept = {}
        monkeypatch.setattr(ordered, "PIECE_ROWS", rows)
        got = ordered.neighbour(df, ["k"], ["t", "n"], ["n"], "p", hot_rows=0)
        assert got.where("p.n = n - 1").count() == 22_500 and got.count() == 30_000
        assert kept["hot-rows"].select("_chunk").distinct().count() <= most


def test_rows_of_one_time_are_dealt_too(spark):
    df = spark.range(20_000).selectExpr("'k' AS k", "CAST('2024-01-01' AS TIMESTAMP_NTZ) AS t", "id AS n")
    got = ordered.neighbour(df, ["k"], ["t", "n"], ["n"], "p", hot_rows=1_000)
    assert got.where("p.n = n - 1").count() == 19_999 and got.where("p IS NULL").count() == 1


@pytest.mark.parametrize("forward", [False, True])
def test_many_pieces_shuffle_rows_once(spark, monkeypatch, forward):
    monkeypatch.setattr(ordered, "PIECE_ROWS", 100)
    df = spark.range(4_000).selectExpr(
        "if(id % 3 > 0, 'hot', if(id % 7 > 0, concat('k', id % 50), NULL)) AS k", "id % 2 = 0 AS even",
        "if(id % 5 > 0, CAST(date_add(DATE '2024-01-01', CAST(id % 11 AS INT)) AS TIMESTAMP_NTZ), NULL) AS t", "id AS n").localCheckpoint()
    find = lambda rows: ordered.neighbour(df, ["k", "even"], ["t", "n"], ["n", "t"], "p", forward=forward, hot_rows=rows)
    got, want = find(1_000), find(10**9)
    assert got.count() == 4_000 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    got.collect()
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange (?:hash|range)partitioning", final)) == 1


def test_rows_equal_in_order_are_each_followed_once(spark, monkeypatch):
    """Also across the bounds of pieces, where the values of equal rows differ."""
    monkeypatch.setattr(ordered, "PIECE_ROWS", 20)
    df = spark.range(1_000).selectExpr("1 AS k", "CAST('2024-01-01' AS TIMESTAMP_NTZ) AS t", "id AS n").localCheckpoint()
    for forward in (False, True):
        met = [r.p.n for r in ordered.neighbour(df, ["k"], ["t"], ["n"], "p", forward=forward, hot_rows=0).collect() if r.p]
        assert len(met) == len(set(met)) == 999


def test_staging_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        found = disk.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before, kept = files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    df = spark.range(10_000).groupBy((F.col("id") % 1_000).alias("k")).count()
    held = staging.staged(df, "groups")
    assert not files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == kept
    assert held.count() == df.count() == 1_000  # what was stored can be run again too


@pytest.mark.parametrize("hot_rows", [10**6, 0])
def test_null_equals_nothing(make, hot_rows):
    day = lambda n: f"2024-01-0{n} 00:00:00"
    rows = [(None, "a", 1, day(1), 10, "sale", 1), (None, "a", 1, day(2), 4, NOTE, 2),
            (-1, "a", 1, day(3), 10, "sale", 3), (-1, "a", 1, day(4), 4, NOTE, 4)]
    got = {r.bill_id: r.quantity for r in lines.net_credit_notes(make(rows, LINE), hot_rows=hot_rows).collect()}
    assert got == {1: 10, 2: 4, 3: 6, 4: 4}
    snaps = make([("", "p", "2024-02-01", day(9)), (None, "p", "2024-01-01", day(1))], SNAP)
    assert {r.gap_entre_compras for r in gaps.purchase_gap(snaps, hot_rows=hot_rows).collect()} == {None}


BOUGHT = "mail string, Periodo string, fecha timestamp_ntz, titulo string, bill_id long, product_id long, quantity int, total_actualizado double, tipo_prd_id int"


def purchases():
    rng = random.Random(5)
    rows = []
    for n in range(250):
        day = f"2024-0{rng.randint(1, 4)}-{rng.randint(10, 12)}"
        rows.append((rng.choice(["a", "b", "c"]), day[:7], f"{day} 00:00:00",
                     rng.choice(["x", "y", "z", "w"]), n, rng.randint(1, 3), 1, 1.0, rng.choice([1, 2])))
    return [*rows, ("one", "2024-01", "2024-01-10 00:00:00", "x", 900, 1, 1, 1.0, 1), (
        None, "2024-01", "2024-01-10 00:00:00", "x", 901, 1, 1, 1.0, 1)]


def literal_contents(rows, distinct):
    groups = {}
    for r in sorted((r for r in rows if r[0]), key=lambda r: (r[2], r[3])):
        groups.setdefault((r[0], r[1]), []).append(r[3])
    return {k: ", ".join(dict.fromkeys(v) if distinct else v) for k, v in groups.items()}


@pytest.mark.parametrize("distinct", [True, False])
def test_contents(make, distinct):
    rows = purchases()
    df = make(rows, BOUGHT)
    want = literal_contents(rows, distinct)
    got = {(r.mail, r.Periodo): r.contenido for r in snapshot.period_contents(df, distinct).collect()}
    assert got == want
    two = {r["mail"]: (r[snapshot.LAST], r[snapshot.BEFORE_LAST])
           for r in snapshot.last_two_contents(df, distinct).collect()}
    for mail in {k[0] for k in want}:
        months = sorted((m for who, m in want if who == mail), reverse=True)
        before = want[mail, months[1]] if len(months) > 1 else None
        assert two[mail] == (want[mail, months[0]], before)


def test_bills_are_cut_to_the_orders_before_they_are_merged(make):
    orders, mails = make([(1,), (1,), (2,)], "ID bigint"), make([(1, "a"), (3, "c")], "post_id bigint, mail string")
    rows = [(1, 10, "b", "2024-01-01 00:00:00")] * 2 + [(2, 20, "b", "2024-01-01 00:00:00"), (3, 30, "b", "2024-01-01 00:00:00"), (None, 40, "b", None)]
    bills = make(rows, "post_id bigint, bill_id bigint, type string, fecha timestamp_ntz").distinct()
    items = make([(10, 7, 1), (10, 8, 2), (20, 7, 3), (30, 7, 4), (40, 7, 5)], "bill_id bigint, product_id bigint, quantity int")
    products = make([(7, "x", "t")], "product_id bigint, titulo string, descripcion string")
    got = lines.assemble_lines(orders, mails, bills, items, products, make([(7, "1")], "product_id bigint, tipo_prd_id string"))
    assert sorted((r.post_id, r.product_id, r.quantity, r.titulo, r.mail) for r in got.collect()) == [
        (1, 7, 1, "x", "a"), (1, 8, 2, None, "a"), (2, 7, 3, "x", None)]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2


def test_contents_with_repeats_of_picked_customers(make):
    """Rows of other customers and months are dropped before their texts are put together."""
    rows = purchases()
    df, some = make(rows, BOUGHT), make([("a",), ("c",), ("none",)], "mail string")
    want = literal_contents(rows, False)
    ranked = snapshot.ranked_contents(df, 2, False, some)
    got = {(r.mail, r.Periodo): r.contenido for r in ranked.collect()}
    latest = {who: sorted((m for w, m in want if w == who), reverse=True)[:2] for who in ("a", "c")}
    assert got == {(who, m): want[who, m] for who, months in latest.items() for m in months}
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_list") < plan.index("LeftSemi") and "_day" not in plan[plan.index("LeftSemi"):]


def test_texts_from_first_titles_are_those_from_all_lines(make):
    """Also with a missing title, month or kind, a title of two kinds, and a customer that comes twice."""
    rows = [*purchases(), ("a", "2024-04", "2024-04-30 00:00:00", None, 910, 1, 1, 1.0, 1), ("b", None, "2024-04-30 00:00:00", "v", 911, 1, 1, 1.0, 1),
            ("c", "2024-04", "2024-04-01 00:00:00", "x", 912, 1, 1, 1.0, None), ("one", "2024-02", "2024-02-10 00:00:00", None, 913, 1, 1, 1.0, 1)]
    df = make(rows, BOUGHT)
    feats = make([("a", 0), ("a", 0), ("b", 1), ("one", 0), ("none", 0)], "mail string, Multimarca int")
    few = snapshot.first_titles(df, feats)
    assert {r.mail for r in few.collect()} == {"a", "b", "one"} and few.count() < df.where("mail IN ('a', 'b', 'one')").count() / 2
    for work in (lambda t: snapshot.products_of_monobrand(t, feats), lambda t: snapshot.last_two_contents(t, True, feats)):
        assert sorted(map(tuple, work(few).collect()), key=str) == sorted(map(tuple, work(df).collect()), key=str)


def test_a_snapshot_reads_the_lines_once_for_texts_without_repeats(make, tmp_path):
    make(purchases(), BOUGHT).write.parquet(str(tmp_path / "lines"))
    segmented = make([("a", 0, 1, 1, 1, "p", "r", 1, 1, 1.0, "2024-04-12 00:00:00")],
                     "mail string, Multimarca int, mezcla_en_misma_compra int, consume_combo int, FF int, cluster_patrones_consumo string, "
                     "rfm string, Recencia int, Frecuencia bigint, ValorMonetario double, ultima_compra timestamp_ntz")
    lines = segmented.sparkSession.read.parquet(str(tmp_path / "lines"))
    reads = lambda distinct: [f for f in snapshot.build_snapshot(segmented, lines, "2024-04-01", distinct).inputFiles() if "/lines/" in f]
    assert not reads(True) and reads(False)
    assert snapshot.build_snapshot(segmented, lines, "2024-04-01").count() == 1


def test_monobrand_products_in_first_seen_order(make):
    rows = [("a", "2024-01", "2024-01-02 00:00:00", "x", 2, 1, 1, 1.0, 1), ("a", "2024-01", "2024-01-01 00:00:00", "y", 1, 1, 1, 1.0, 1),
            ("a", "2024-02", "2024-02-01 00:00:00", "x", 3, 1, 1, 1.0, 1), ("a", "2024-02", "2024-02-01 00:00:00", "o", 4, 1, 1, 1.0, 2),
            ("b", "2024-02", "2024-02-01 00:00:00", "x", 5, 1, 1, 1.0, 1)]
    feats = make([("a", 0), ("b", 1)], "mail string, Multimarca int")
    df = make(rows, BOUGHT)
    assert [tuple(r) for r in snapshot.products_of_monobrand(df, feats).collect()] == [("a", "y, x")]
    assert snapshot.products_of_monobrand(df, feats, style="list").first()[1] == "['y' 'x']"


SNAP = "mail string, rfm string, fecha_segmentacion date, ultima_compra timestamp_ntz"
SNAPS = [("a", "p", "2024-01-01", "2024-01-01 12:00:00"), ("a", "q", "2024-02-01", "2024-01-03 06:00:00"),
         ("a", "p", "2024-03-01", "2024-03-05 12:00:00"), ("b", "p", "2024-01-01", "2024-01-01 00:00:00"),
         (None, "p", "2024-01-01", "2024-01-01 00:00:00"), (None, "p", "2024-02-01", "2024-01-31 00:00:00"),
         ("c", "p", "2024-01-01", None), ("c", "p", "2024-02-01", "2024-01-01 00:00:00")]


@pytest.mark.parametrize("hot_rows", [10**6, 0])
def test_gaps(make, hot_rows):
    df = make(SNAPS, SNAP)
    pick = lambda d: {(r.mail, str(r.fecha_segmentacion)): r.gap_entre_compras for r in d.collect()}
    over_all = pick(gaps.purchase_gap(df, hot_rows=hot_rows))
    assert over_all["a", "2024-02-01"] == 1 and over_all["a", "2024-03-01"] == 62
    assert over_all["a", "2024-01-01"] is None and over_all[None, "2024-02-01"] is None
    assert over_all["c", "2024-01-01"] is None and len(over_all) == len(SNAPS)
    within = pick(gaps.purchase_gap(df, within_label=True, hot_rows=hot_rows))
    assert within["a", "2024-02-01"] is None and within["a", "2024-03-01"] == 64


def test_transitions(make):
    df = make(SNAPS[:4] + [("a", None, "2024-04-01", None), ("a", "p", "2024-05-01", None)], SNAP)
    prev = {(r.mail, str(r.fecha_segmentacion)): r.rfm_anterior for r in transitions.previous_state(df).collect()}
    assert prev["a", "2024-02-01"] == "p" and prev["a", "2024-05-01"] is None and prev["b", "2024-01-01"] is None
    edges = {(r.rfm_anterior, r.rfm): r.cantidad for r in transitions.transition_edges(df).collect()}
    assert edges == {("p", "q"): 1, ("q", "p"): 1}


def test_edges_count_all_but_first_snapshots(make):
    df = make([r for r in SNAPS if r[0]], SNAP)
    assert sum(r.cantidad for r in transitions.transition_edges(df).collect()) == (3 - 1) + 0 + (2 - 1)
    moves = transitions.transition_edges(df).unionByName(make([("p", "nuevo", 3)], "rfm_anterior string, rfm string, cantidad long"))
    for labels in (None, ["q"]):
        wide = transitions.transition_matrix(moves, labels)
        assert all(abs(r["p"] + r["q"] + r["nuevo"] - 1) < 1e-12 for r in wide.collect())
    wide = transitions.transition_matrix(transitions.transition_edges(df), ["p", "q"])
    assert all(abs(r["p"] + r["q"] - 1) < 1e-12 for r in wide.collect())
