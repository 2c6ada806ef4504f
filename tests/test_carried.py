"""Carried state against the operators that look at all months."""

import random

import pytest
from pyspark.sql import functions as F

from clientela.operators import distinct, features, ledger, pricing, states, transitions
from clientela.operators.gaps import purchase_gap
from clientela.plans import jobs

LINES = ("mail string, bill_id long, product_id long, quantity int, fecha timestamp_ntz, total_actualizado double, tipo_prd_id int, "
         "MARCA string, Combo int, Presentacion string, `CATEGORÍA` string, Periodo string")


def random_lines(month, n, seed):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        kind = r.choice([1, 1, 2, None])
        rows.append((r.choice(["a", "b", "c", "d", "e", "", None]), r.choice([None, *range(month * 10, month * 10 + 6)]),
                     r.choice([None, 1, 2, 3, 4, 5]), r.choice([1, 2, 7, 0, 3]), f"2024-{month:02d}-{r.randint(1, 28):02d} 10:00:00",
                     r.choice([None, *[float(r.randint(1, 400)) / 4] * 6]), kind, r.choice([None, "x", "y", "z"]), r.choice([0, 0, 0, 1]),
                     r.choice(["Box", "Soft_pack", None]), r.choice(["FF", "FF", "FF", "otros", None]), f"2024-{month:02d}"))
    return rows


def close(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect())


@pytest.mark.parametrize("zero_is_multi", [False, True])
def test_profile_of_merged_months(spark, make, zero_is_multi):
    for seed in range(3):
        months = [make(random_lines(m, 14, 10 * seed + m), LINES) for m in (1, 2, 3)]
        state = ledger.month_state(months[0])
        for m in months[1:]:
            state = ledger.merge_states(state, ledger.month_state(m))
        whole = months[0].unionByName(months[1]).unionByName(months[2]).na.drop(subset=["mail", "fecha", "total_actualizado"])
        want = features.customer_profile(whole, zero_is_multi)
        assert close(ledger.ledger_profile(state["ledger"], zero_is_multi).select(want.columns)) == close(want)
        unit = pricing.first_per_key(whole.where("product_id IS NOT NULL"), ["product_id"], ["fecha", "bill_id", "quantity", "total_actualizado"])
        columns = ["product_id", "fecha", "quantity", "total_actualizado"]
        assert close(state["firsts"].select(columns)) == close(unit.select(columns))


def test_three_months_at_current_money(spark, make, tmp_path):
    """The same values as repricing all lines each month; a repeated month gives the same state."""
    tie = ("bill_id", "quantity", "total_actualizado")
    valued = lambda m: make([r for r in random_lines(m, 30, m) if r[5] is not None and r[0] is not None], LINES)
    history = state = None
    for m, known in ((1, [1, 2, 3]), (2, [2, 4]), (3, [1, 4])):
        now = valued(m)
        prices = make([(p, 10.0 * m + p) for p in known], "product_id long, precio double")
        history = jobs.accumulate(history, now, prices, f"2024-{m:02d}", tie=tie)
        before = state
        made = jobs.accumulate_ledger(before, now, prices, tie=tie)
        state = {}
        for name, df in made.items():
            df.write.parquet(str(tmp_path / f"{m}-{name}"))
            state[name] = spark.read.parquet(str(tmp_path / f"{m}-{name}"))
        again = jobs.accumulate_ledger(before, now, prices, tie=tie)
        assert close(again["ledger"].select(sorted(again["ledger"].columns))) == close(state["ledger"].select(sorted(again["ledger"].columns)))
        columns = ["mail", "ValorMonetario", "Frecuencia", "ultima_compra", "Multimarca", "FF", "mezcla_en_misma_compra"]
        whole = history.na.drop(subset=["mail", "fecha", "total_actualizado"])
        assert close(ledger.ledger_profile(state["ledger"]).select(columns)) == close(features.customer_profile(whole).select(columns))


def test_a_month_reads_itself_and_the_ledger(spark, make, tmp_path):
    for name, m in (("history", 1), ("month", 2)):
        make(random_lines(m, 30, m), LINES).write.parquet(str(tmp_path / name))
    history, month = (spark.read.parquet(str(tmp_path / n)) for n in ("history", "month"))
    for name, df in ledger.month_state(history).items():
        df.write.parquet(str(tmp_path / name))
    state = {n: spark.read.parquet(str(tmp_path / n)) for n in ("ledger", "firsts")}
    merged = ledger.merge_states(state, ledger.month_state(month))
    profile = ledger.ledger_profile(merged["ledger"])
    read = {f.split("/")[-2] for f in profile.inputFiles()}
    assert read == {"ledger", "month"}
    assert "ReadSchema: struct<mail:string,bill_id" in profile._jdf.queryExecution().executedPlan().toString()


def test_states_follow_snapshots(spark, make):
    """Three dates and re-runs of the second and third: as if all were looked at together."""
    r = random.Random(6)
    mails = [f"m{i}" for i in range(30)]
    rows = [(m, f"2024-0{k}-01", r.choice(["x", "y", None]), f"2024-0{k}-{r.randint(1, 28):02d} 0{k}:00:00")
            for k in (1, 2, 3) for m in mails if r.random() < 0.7] + [(None, f"2024-0{k}-01", "x", f"2024-0{k}-05 00:00:00") for k in (1, 2, 3)]
    snaps = make(rows, "mail string, fecha_segmentacion date, rfm string, ultima_compra timestamp_ntz")
    latest, moves, parts = states.start(snaps), [], None
    for date in ("2024-01-01", "2024-02-01", "2024-03-01"):
        now = snaps.where(F.col("fecha_segmentacion") == date)
        runs = [now] if date == "2024-01-01" else [now.limit(9).withColumn("rfm", F.lit("wrong")), now.withColumn("rfm", F.lit("y")), now]
        for run in runs:
            met, latest = (spark.createDataFrame(x.collect(), x.schema) for x in states.advance(latest, run, date))
            own = states.edge_part(met)
            parts = own if parts is None else states.without_date(parts, date).unionByName(own)
            parts = spark.createDataFrame(parts.collect(), parts.schema)
        moves.append(met)
    got = moves[0].unionByName(moves[1]).unionByName(moves[2])
    columns = ["mail", "fecha_segmentacion", "gap_entre_compras", "segmento_gap"]
    key = lambda df: sorted(map(str, df.collect()))
    assert key(got.select(columns)) == key(purchase_gap(snaps).select(columns))
    known = got.where("mail IS NOT NULL").select("mail", "fecha_segmentacion", "rfm_anterior")
    assert key(known) == key(transitions.previous_state(snaps).select(known.columns))
    assert key(states.edges(parts)) == key(transitions.transition_edges(snaps))
    assert latest.count() == len({m for m, *_ in rows if m})


def test_distinct_customers_add_up(spark):
    r = random.Random(9)
    registry = bits = None
    seen, rows = set(), []
    for month in range(3):
        now = [(r.choice([None, *(f"c{k}" for k in range(40 * (month + 1)))]), r.choice(["x", "y", None])) for _ in range(150)]
        rows += now
        seen |= {m for m, _ in now if m is not None}
        table = spark.createDataFrame(now, "mail string, g string").repartition(3)
        registry = spark.createDataFrame(distinct.enroll(registry, table).collect(), "mail string, n long")
        assert {x.mail for x in registry.collect()} == seen
        assert sorted(x.n for x in registry.collect()) == list(range(1, len(seen) + 1))  # no gaps
        one = distinct.month_bitmaps(table, registry, ["g"])
        bits = one if bits is None else bits.unionByName(one)
    got = {x.g: (x.cantidad_de_clientes, x.filas) for x in distinct.distinct_counts(bits, ["g"]).collect()}
    assert got == {g: (len({m for m, h in rows if h == g and m is not None}), sum(h == g for _, h in rows)) for g in ("x", "y", None)}
    total = distinct.distinct_counts(bits, []).first()
    assert (total.cantidad_de_clientes, total.filas) == (len(seen), len(rows))
    far = spark.range(32_766, 32_772).selectExpr("CAST(id AS STRING) AS mail", "id AS n")
    assert distinct.distinct_counts(distinct.month_bitmaps(far, far, []), []).first().cantidad_de_clientes == 6
