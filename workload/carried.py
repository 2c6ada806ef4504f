"""State that is carried from month to month, next to the SQL over all months."""

import uuid

from pyspark.sql import functions as F

from clientela.operators import distinct as DI
from clientela.operators import features as X
from clientela.operators import gaps as G
from clientela.operators import ledger as L
from clientela.operators import monthly as MO
from clientela.operators import profile as D
from clientela.operators import states as ST
from clientela.operators.lines import assemble_lines, eav_attribute, in_month
from clientela.plans import jobs as J
from clientela.sources import buckets as B
from clientela.sources import months as MT
from clientela.sources.staging import stage_path, staged
from workload.base import ACCOUNTS, ATTRIBUTED, LINES, ORACLES, RFM, SNAPSHOTS, TIE, query, sale_lines, shop, table, weekly_snapshots
from workload.customers import FEATURES, _gap_sql, account_lines, rounded
from workload.jobs import _ACC_MONTH, AS_OF, RULES, SEGMENTS, SNAP_DATE
from workload.relations import MONTH


def stored(state, name):
    return {k: staged(v, f"{name}-{k}") for k, v in state.items()}


#: What a month's state is made from.
LEDGER_LINES = tuple(dict.fromkeys((
    "mail", "product_id", "bill_id", "fecha", "quantity", "total_actualizado", "tipo_prd_id", "MARCA", "CATEGORÍA", "Combo",
    "Presentacion", *TIE)))


def two_months(lines):
    """The state after two months; a bill belongs to one of them."""
    first, second = (stored(L.month_state(lines.where(F.col("bill_id") % 2 == i), TIE), "month") for i in (0, 1))
    return stored(L.merge_states(first, second, TIE), "merged")


@query("ledger_profile", f"""WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES}, {RFM}
SELECT labelled.*, rfm.* EXCLUDE (mail) REPLACE (round("ValorMonetario", 2) AS "ValorMonetario"), u.ultima_compra
FROM labelled JOIN rfm USING (mail) JOIN (SELECT mail, max(fecha) AS ultima_compra FROM lines GROUP BY mail) u USING (mail)""")
def ledger_profile(spark, d):
    """Profile and RFM of all lines, from the merged state of two months."""
    state = two_months(staged(account_lines(spark, d).select(*LEDGER_LINES), "history"))
    return rounded(X.with_recency(L.ledger_profile(state["ledger"])), 2, "ValorMonetario")


_UNROUNDED = ORACLES["accumulate"].replace("round(CASE WHEN", "(CASE WHEN").replace(" END, 4) AS", " END) AS")


@query("ledger_accumulate", f"""WITH money AS ({_UNROUNDED})
SELECT mail, round(sum(total_actualizado), 2) AS "ValorMonetario", count(fecha) AS "Frecuencia", max(fecha) AS ultima_compra
FROM money WHERE mail IS NOT NULL GROUP BY mail""")
def ledger_accumulate(spark, d):
    """The history at current money plus a month, per customer, without its lines: the state of the
    months before, prices joined to it, and the month's own state."""
    lines = sale_lines(spark, d).withColumns({"Combo": F.lit(0), "Presentacion": F.lit("Box")})
    lines = staged(lines.select(*LEDGER_LINES), "lines")  # each month's state reads them three times
    now = lines.filter(in_month(F.col("fecha"), _ACC_MONTH))
    old = lines.filter(F.col("fecha") < F.lit(f"{_ACC_MONTH}-01").cast("timestamp_ntz"))
    log = shop(spark, d)["prices"].withColumn("product_id", F.col("product_id") - 1_000_000_000)
    before = stored(L.month_state(old, TIE), "before")
    state = J.accumulate_ledger(before, now, J.month_prices(log, now), tie=TIE)
    profile = L.ledger_profile(state["ledger"])
    return rounded(profile.select("mail", "ValorMonetario", "Frecuencia", "ultima_compra"), 2, "ValorMonetario")


@query("ledger_segments", f"""WITH {SEGMENTS}
SELECT * REPLACE (round("ValorMonetario", 2) AS "ValorMonetario") FROM segments""")
def ledger_segments(spark, d):
    """Segmentation whose features and RFM come from the carried ledger."""
    history = staged(account_lines(spark, d), "history")
    done = J.segment_customers(history, AS_OF, SNAP_DATE, RULES, carried=two_months(history)["ledger"])
    return rounded(done, 2, "ValorMonetario")


def followed(spark, d):
    """Moves of all weekly snapshots, one after the other; the second last is first run with other
    labels and half its customers, then run again."""
    snaps = staged(weekly_snapshots(spark, d), "snaps")
    dates = [r[0] for r in snaps.select("fecha_segmentacion").distinct().orderBy("fecha_segmentacion").collect()]  # weeks
    latest, moves, parts = ST.start(snaps), None, None
    for i, date in enumerate(dates):
        now = snaps.where(F.col("fecha_segmentacion") == F.lit(date))
        if i == len(dates) - 2:
            wrong = now.where(F.col("mail").cast("long") % 2 == 0).withColumn("rfm", F.lit("wrong"))
            met, latest = (staged(x, "wrong") for x in ST.advance(latest, wrong, date))
            parts = ST.edge_part(met) if parts is None else parts.unionByName(ST.edge_part(met))
        met, latest = (staged(x, "state") for x in ST.advance(latest, now, date))
        moves = met if moves is None else moves.unionByName(met)
        parts = ST.edge_part(met) if parts is None else ST.without_date(parts, date).unionByName(ST.edge_part(met))
        parts = staged(parts, "edges")
    return moves, parts


@query("state_moves", f"""WITH {SNAPSHOTS}, {_gap_sql('mail')}
SELECT mail, fecha_segmentacion, rfm, ultima_compra, gap_entre_compras, segmento_gap,
  lag(rfm) OVER (PARTITION BY mail ORDER BY fecha_segmentacion) AS rfm_anterior FROM gaps""")
def state_moves(spark, d):
    """Previous label and gap of every snapshot row, each snapshot joined once to the state before."""
    return followed(spark, d)[0]


@query("state_edges", f"""WITH {SNAPSHOTS}, moves AS (SELECT rfm, lag(rfm) OVER (PARTITION BY mail ORDER BY fecha_segmentacion) AS rfm_anterior FROM snaps)
SELECT rfm_anterior, rfm, count(*) AS cantidad FROM moves WHERE rfm_anterior IS NOT NULL AND rfm IS NOT NULL GROUP BY 1, 2""")
def state_edges(spark, d):
    """Edge counts as sums of what each date adds."""
    return ST.edges(followed(spark, d)[1])


def weekly_bitmaps(spark, d):
    """Bitmaps of each week's gaps, each made from its week alone; customers are enrolled week by week."""
    rows = staged(G.purchase_gap(weekly_snapshots(spark, d)), "gaps")
    weeks = [r[0] for r in rows.select("fecha_segmentacion").distinct().orderBy("fecha_segmentacion").collect()]
    registry = stored_bits = None
    for week in weeks:
        now = rows.where(F.col("fecha_segmentacion") == F.lit(week))
        registry = staged(DI.enroll(registry, now), "registry")
        bits = staged(DI.month_bitmaps(now, registry, ["rfm", "segmento_gap"]), "bitmaps")
        stored_bits = bits if stored_bits is None else stored_bits.unionByName(bits)
    return stored_bits


@query("gap_distribution_bitmaps", ORACLES["gap_distribution"])
def gap_distribution_bitmaps(spark, d):
    """Customers and rows per segment and band over all weeks, from the weeks' bitmaps."""
    return DI.distinct_counts(weekly_bitmaps(spark, d).where(F.col("rfm").isNotNull()), ["rfm", "segmento_gap"])


@query("n_distinct_bitmaps", f"""WITH {SNAPSHOTS} SELECT rfm, count(DISTINCT mail) AS cantidad_de_clientes, count(*) AS filas FROM snaps GROUP BY 1""")
def n_distinct_bitmaps(spark, d):
    """The same bitmaps united further, over the bands."""
    return DI.distinct_counts(weekly_bitmaps(spark, d), ["rfm"])


_MEASURES, _RANKS = ("l_quantity", "l_extendedprice"), (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)


def _flag_quantile(col, p):
    return f"""SELECT l_returnflag, '{col}' AS columna, CAST({p!r} AS DOUBLE) AS p, count({col}) AS n,
  round(quantile_cont({col}, {p!r}), 6) AS valor FROM lineitem WHERE l_returnflag IS NOT NULL AND l_shipdate IS NOT NULL GROUP BY l_returnflag"""


@query("quantiles_of_months", " UNION ALL ".join(_flag_quantile(c, p) for c in _MEASURES for p in _RANKS))
def quantiles_of_months(spark, d):
    """Quantiles per return flag over all years, stored year by year; the last is first stored with half its rows."""
    lines = table(spark, d, "lineitem").withColumn("Periodo", F.year("l_shipdate"))
    folder, by = stage_path(spark, "quantile-months"), ["l_returnflag"]
    last = lines.agg(F.max("Periodo")).first()[0]
    half = lines.where((F.col("Periodo") == F.lit(last)) & (F.col("l_orderkey") % 2 == 0))
    MO.store_months(MO.month_values(half, _MEASURES, by), folder)
    MO.store_months(MO.month_values(lines, _MEASURES, by), folder)
    return rounded(MO.quantiles_of_months(*MO.stored_months(spark, folder), _RANKS, by), 6, "valor")


HISTORY = ("post_id", "product_id", "l_linenumber", "l_suppkey", "total_actualizado", "Periodo", "quantity")


@query("upsert_months", ORACLES["upsert_period"])
def upsert_months(spark, d):
    """`upsert_period` on a history stored by month, of which only the other months are read; twice."""
    lines, folder = sale_lines(spark, d).select(*HISTORY), stage_path(spark, "history-months")
    MT.store_by_month(lines, folder)
    schema = lines.schema
    new = staged(MT.stored_table(spark, folder, schema).where(F.col("Periodo") >= MONTH).withColumn("quantity", F.col("quantity") + 1), "new")
    once, again = MT.upsert_months(MT.stored_table(spark, folder, schema), folder, new), stage_path(spark, "history-again")
    MT.store_by_month(once, again)
    return MT.upsert_months(MT.stored_table(spark, again, schema), again, new)


@query("latest_snapshot", f"""WITH {SNAPSHOTS} SELECT * FROM snaps WHERE fecha_segmentacion = (SELECT max(fecha_segmentacion) FROM snaps)""")
def latest_snapshot(spark, d):
    """The current snapshot of a table stored by snapshot, without its date being given."""
    snaps, folder = weekly_snapshots(spark, d), stage_path(spark, "snapshots")
    MT.store_by_month(snaps, folder, "fecha_segmentacion")
    kind = snaps.schema["fecha_segmentacion"].dataType.simpleString()
    return MT.of_months(MT.stored_table(spark, folder, snaps.schema), MT.latest_month(spark, folder, "fecha_segmentacion", kind), "fecha_segmentacion")


BUCKETS, HOT_LINES = 8, 50   # the given tables are small


def bucketed(spark, df, key):
    name, counts = f"t{uuid.uuid4().hex}", staged(B.key_rows(df, key), "key-rows")
    return B.store_bucketed(df, name, stage_path(spark, name), key, B.bucket_number(counts, BUCKETS), B.hot_keys(counts, key, HOT_LINES))


@query("bucketed_profile", ORACLES["customer_profile"])
def bucketed_profile(spark, d):
    """`customer_profile` of a history bucketed by customer, which is not shuffled."""
    return X.with_recency(B.per_key(X.customer_profile, bucketed(spark, account_lines(spark, d), "mail")))


@query("bucketed_lines", ORACLES["assemble_lines"])
def bucketed_lines(spark, d):
    """`assemble_lines` with items bucketed by bill: the bills of the orders are brought to them."""
    t = shop(spark, d)
    kinds = eav_attribute(t["attributes"], "tipo_prd_id", "tipo_prd_id").withColumnRenamed("post_id", "product_id")
    mails = eav_attribute(t["attributes"], "_billing_email", "mail")
    return B.per_key(lambda items: assemble_lines(t["orders"], mails, t["bills"], items, t["products"], kinds),
                     bucketed(spark, t["items"], "bill_id"))


@query("modes", f"""WITH {LINES}, {', '.join(f"""m_{i} AS (SELECT '{c}' AS columna, (SELECT count("{c}") FROM lines) AS count,
  CAST("{c}" AS VARCHAR) AS top, count(*) AS freq FROM lines WHERE "{c}" IS NOT NULL GROUP BY 3 ORDER BY 4 DESC, 3 LIMIT 1)"""
  for i, c in enumerate(("titulo", "MARCA", "mail", "product_id")))}
{' UNION ALL '.join(f"SELECT * FROM m_{i}" for i in range(4))}""")
def modes(spark, d):
    return D.modes(sale_lines(spark, d), ["titulo", "MARCA", "mail", "product_id"])
