"""Prices, features, RFM, statistics, snapshots, gaps, transitions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.operators import features as X
from clientela.operators import gaps as G
from clientela.operators import pricing as P
from clientela.operators import profile as D
from clientela.operators import relational as R
from clientela.operators import rfm as M
from clientela.operators import snapshot as N
from clientela.operators.lines import in_month
from clientela.operators import transitions as T
from clientela.operators.ordered import last_per_key
from clientela.sources.staging import staged
from workload.base import (
    ACCOUNTS, ATTRIBUTED, LATEST, LINES, PRICE_LOG, PRICE_TIE, RFM, SNAPSHOTS, STATES, TIE,
    price_log, priced_attributes, query, sale_lines, states, table, weekly_snapshots)

MONTH = "2001-10"


def rounded(df: DataFrame, digits: int = 6, *cols: str) -> DataFrame:
    """Fixed digits for computed doubles, so both engines' sums compare equal."""
    cols = cols or [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# --- prices --------------------------------------------------------------------------------

@query("latest_price", f"WITH {PRICE_LOG}, {LATEST} SELECT * FROM latest")
def latest_price(spark, d):
    return P.latest_price(price_log(spark, d), PRICE_TIE)


@query("units_by_product", f"WITH {LINES} SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM lines GROUP BY 1")
def units_by_product(spark, d):
    return P.units_by_product(sale_lines(spark, d))


TOP = """top AS (SELECT product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM lines GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 4)"""


@query("top_k_products", f"WITH {LINES}, {TOP} SELECT * FROM top")
def top_k_products(spark, d):
    return P.top_k_products(sale_lines(spark, d))


def _month_split(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The month and what is before it, by ranges of the date that reach the scan."""
    start = F.lit(f"{MONTH}-01").cast("timestamp_ntz")
    return lines.filter(in_month(F.col("fecha"), MONTH)), lines.filter(F.col("fecha") < start)


_INDEX_TIE = "fecha, bill_id, l_linenumber, l_suppkey, quantity, total_actualizado"
INDEX = f"""top AS (SELECT product_id FROM lines WHERE "Periodo" = '{MONTH}' GROUP BY 1
  ORDER BY sum(quantity) DESC, 1 LIMIT 4),
old AS (SELECT CAST(total_actualizado AS DOUBLE) / quantity AS viejo FROM (
  SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY {_INDEX_TIE}) AS rn FROM lines
  WHERE "Periodo" < '{MONTH}' AND product_id IN (SELECT product_id FROM top)) WHERE rn = 1),
idx AS (SELECT COALESCE((SELECT CAST(sum(precio) AS DOUBLE) FROM latest
    WHERE product_id IN (SELECT product_id FROM top)), 0) AS canasta_nueva,
  COALESCE((SELECT sum(viejo) FROM old), 0) AS canasta_vieja)"""
_IDX_TIE = ("bill_id", "l_linenumber", "l_suppkey", "quantity", "total_actualizado")


@query("basket_index", f"""WITH {LINES}, {PRICE_LOG}, {LATEST}, {INDEX}
SELECT round(canasta_nueva, 6) AS canasta_nueva, round(canasta_vieja, 6) AS canasta_vieja,
  round(CASE WHEN canasta_vieja > 0 THEN canasta_nueva / canasta_vieja ELSE 1.0 END, 6) AS indice FROM idx""")
def basket_index(spark, d):
    now, old = _month_split(sale_lines(spark, d))
    return rounded(P.basket_index(now, P.latest_price(price_log(spark, d), PRICE_TIE), old, tie=_IDX_TIE))


@query("reprice_history", f"""WITH {LINES}, {PRICE_LOG}, {LATEST}, {INDEX}
SELECT h.post_id, h.product_id, h.l_linenumber, h.l_suppkey, h.quantity, h.fecha, round(p, 6) AS precio,
  round(p * h.quantity, 4) AS total_actualizado, h.total_actualizado AS anterior
FROM (SELECT l.*, COALESCE(CAST(n.precio AS DOUBLE), CAST(l.total_actualizado AS DOUBLE) / l.quantity *
    (SELECT CASE WHEN canasta_vieja > 0 THEN canasta_nueva / canasta_vieja ELSE 1.0 END FROM idx)) AS p
  FROM lines l LEFT JOIN latest n USING (product_id) WHERE l."Periodo" < '{MONTH}') h""")
def reprice_history(spark, d):
    now, old = _month_split(sale_lines(spark, d))
    prices = P.latest_price(price_log(spark, d), PRICE_TIE)
    index = P.basket_index(now, prices, old, tie=_IDX_TIE)
    # A price left by an earlier month must not survive.
    stale = old.withColumn("precio", F.lit(1.0)).withColumn("anterior", F.col("total_actualizado"))
    out = P.reprice_history(stale, prices, index)
    return out.select("post_id", "product_id", "l_linenumber", "l_suppkey", "quantity", "fecha",
                      F.round("precio", 6).alias("precio"),
                      F.round("total_actualizado", 4).alias("total_actualizado"), "anterior")


# --- features ------------------------------------------------------------------------------

FEATURES = """features AS (
  SELECT mail, max(CASE WHEN tipo_prd_id = 2 THEN 1 ELSE 0 END) AS otros_productos,
    CASE WHEN count(DISTINCT CASE WHEN tipo_prd_id = 1 THEN "MARCA" END) > 1 THEN 1 ELSE 0 END AS "Multimarca",
    max("Combo") AS consume_combo,
    max(CASE WHEN tipo_prd_id = 1 AND "Presentacion" = 'Box' THEN 1 ELSE 0 END) AS box,
    max(CASE WHEN tipo_prd_id = 1 AND "Presentacion" = 'Soft_pack' THEN 1 ELSE 0 END) AS soft_pack,
    max(CASE WHEN tipo_prd_id = 1 AND bill_id IN (SELECT bill_id FROM attributed WHERE tipo_prd_id = 1
      GROUP BY bill_id HAVING count(DISTINCT "MARCA") > 1) THEN 1 ELSE 0 END) AS mezcla_en_misma_compra,
    min(CASE WHEN "CATEGORÍA" = 'FF' THEN 1 ELSE 0 END) AS "FF"
  FROM attributed GROUP BY mail),
labelled AS (SELECT *, CASE WHEN "FF" = 1 THEN 'FF - ' ELSE 'No FF - ' END ||
    CASE WHEN "Multimarca" = 1 THEN 'Multimarca' ELSE 'Monomarca' END AS cluster_patrones_consumo FROM features)"""


def account_lines(spark, d) -> DataFrame:
    return priced_attributes(sale_lines(spark, d, account=True))


@query("customer_features", f"WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES} SELECT * FROM labelled")
def customer_features(spark, d):
    return X.customer_features(account_lines(spark, d))


@query("customer_features_v1", f"""WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES}
SELECT mail, CASE WHEN n = 1 THEN 0 ELSE 1 END AS "Multimarca" FROM (
  SELECT mail, count(DISTINCT CASE WHEN tipo_prd_id = 1 THEN "MARCA" END) AS n FROM attributed GROUP BY mail)""")
def customer_features_v1(spark, d):
    return X.customer_features(account_lines(spark, d), zero_is_multi=True).select("mail", "Multimarca")


@query("customer_profile", f"""WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES}, {RFM}
SELECT labelled.*, rfm.* EXCLUDE (mail), u.ultima_compra FROM labelled JOIN rfm USING (mail)
JOIN (SELECT mail, max(fecha) AS ultima_compra FROM lines GROUP BY mail) u USING (mail)""")
def customer_profile(spark, d):
    return X.with_recency(X.customer_profile(account_lines(spark, d)))


@query("mixed_brand_bills", f"""WITH {LINES}
SELECT bill_id, count(DISTINCT "MARCA") AS marcas FROM lines WHERE tipo_prd_id = 1
GROUP BY bill_id HAVING count(DISTINCT "MARCA") > 1""")
def mixed_brand_bills(spark, d):
    return X.mixed_brand_bills(sale_lines(spark, d))


@query("mixing_customers", f"""WITH {ACCOUNTS}
SELECT DISTINCT mail FROM lines WHERE tipo_prd_id = 1 AND bill_id IN (SELECT bill_id FROM lines
  WHERE tipo_prd_id = 1 GROUP BY bill_id HAVING count(DISTINCT "MARCA") > 1)""")
def mixing_customers(spark, d):
    return X.mixing_customers(sale_lines(spark, d, account=True))


@query("brand_count", f"""WITH {ACCOUNTS}
SELECT mail, count(DISTINCT CASE WHEN tipo_prd_id = 1 THEN "MARCA" END) AS marcas FROM lines GROUP BY mail""")
def brand_count(spark, d):
    return X.brand_count(sale_lines(spark, d, account=True))


# --- RFM -----------------------------------------------------------------------------------

@query("rfm", f"WITH {LINES}, {RFM} SELECT * FROM rfm")
def rfm(spark, d):
    return M.rfm(sale_lines(spark, d))


@query("rfm_rounded", f"""WITH {LINES}, {RFM}
SELECT mail, round_even("ValorMonetario", 2) AS "ValorMonetario", "Frecuencia", "Recencia" FROM rfm""")
def rfm_rounded(spark, d):
    return M.rfm(sale_lines(spark, d), rounded=True)


@query("rfm_subday", """
SELECT CAST(user_id AS VARCHAR) AS mail, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS "ValorMonetario",
  count(*) AS "Frecuencia",
  CAST(date_sub('day', max(ts), (SELECT max(ts) FROM events)) AS INTEGER) AS "Recencia"
FROM events GROUP BY 1""")
def rfm_subday(spark, d):
    """Times within the day: recency counts whole 24-hour periods."""
    return M.rfm(table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("mail"), F.col("ts").alias("fecha"),
        F.col("value").cast("decimal(18,2)").alias("total_actualizado")))


@query("merge_rfm", f"WITH {LINES}, {RFM} SELECT * FROM rfm")
def merge_rfm(spark, d):
    scores = M.rfm(sale_lines(spark, d))
    return M.merge_rfm(*[scores.select("mail", c) for c in ("ValorMonetario", "Frecuencia", "Recencia")])


@query("last_purchase", f"WITH {LINES} SELECT mail, max(fecha) AS ultima_compra FROM lines GROUP BY mail")
def last_purchase(spark, d):
    return R.last_purchase(sale_lines(spark, d))


def _quartiles(c: str) -> str:
    return (f'quantile_cont("{c}", 0.25) AS a_{c}, quantile_cont("{c}", 0.75) AS b_{c}')


_INSIDE = " AND ".join(
    f'"{c}" >= a_{c} - 1.5 * (b_{c} - a_{c}) AND "{c}" <= b_{c} + 1.5 * (b_{c} - a_{c})'
    for c in ("ValorMonetario", "Frecuencia", "Recencia"))
KEPT = f"""quart AS (SELECT {", ".join(_quartiles(c) for c in ("ValorMonetario", "Frecuencia", "Recencia"))}
  FROM (SELECT "ValorMonetario", CAST("Frecuencia" AS DOUBLE) AS "Frecuencia",
    CAST("Recencia" AS DOUBLE) AS "Recencia" FROM rfm)),
kept AS (SELECT rfm.* FROM rfm, quart WHERE {_INSIDE})"""


@query("iqr_filter", f"WITH {LINES}, {RFM}, {KEPT} SELECT * FROM kept")
def iqr_filter(spark, d):
    return M.iqr_filter(staged(M.rfm(sale_lines(spark, d)), "rfm"))  # bounds and filter read it


@query("quantiles", """
SELECT c AS columna, p, round(quantile, 6) AS valor FROM (
  SELECT 'l_quantity' AS c, p, CASE p WHEN 0.1 THEN quantile_cont(l_quantity, 0.1)
    WHEN 0.5 THEN quantile_cont(l_quantity, 0.5) ELSE quantile_cont(l_quantity, 0.99) END AS quantile
  FROM lineitem, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.99::DOUBLE)) v(p) GROUP BY p
  UNION ALL
  SELECT 'l_extendedprice', p, CASE p WHEN 0.1 THEN quantile_cont(l_extendedprice, 0.1)
    WHEN 0.5 THEN quantile_cont(l_extendedprice, 0.5) ELSE quantile_cont(l_extendedprice, 0.99) END
  FROM lineitem, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.99::DOUBLE)) v(p) GROUP BY p)""")
def quantiles(spark, d):
    return rounded(D.quantiles(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice"],
                               (0.1, 0.5, 0.99)), 6, "valor")


# --- statistics ----------------------------------------------------------------------------

def _describe_sql(col: str, name: str, source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    x = f"CAST({col} AS DOUBLE)"
    return f"""SELECT {lead}'{name}' AS columna, count({col}) AS count, round(avg({x}), 6) AS mean,
  round(stddev_samp({x}), 6) AS std, min({x}) AS min, max({x}) AS max, round(quantile_cont({x}, 0.25), 6) AS q25,
  round(quantile_cont({x}, 0.5), 6) AS q50, round(quantile_cont({x}, 0.75), 6) AS q75 FROM {source}""" + (
        f" WHERE {by} IS NOT NULL GROUP BY {by}" if by else "")


def _described(df: DataFrame) -> DataFrame:
    return rounded(df, 6, "mean", "std", "q25", "q50", "q75")


@query("describe", f"""WITH {LINES}
{_describe_sql('quantity', 'quantity', 'lines')}
UNION ALL {_describe_sql('total_actualizado', 'total_actualizado', 'lines')}""")
def describe(spark, d):
    return _described(D.describe(sale_lines(spark, d), ["quantity", "total_actualizado"]))


@query("describe_by", f"""WITH {LINES}
{_describe_sql('quantity', 'quantity', 'lines', '"MARCA"')}
UNION ALL {_describe_sql('total_actualizado', 'total_actualizado', 'lines', '"MARCA"')}""")
def describe_by(spark, d):
    return _described(D.describe(sale_lines(spark, d), ["quantity", "total_actualizado"], by="MARCA"))


def _mode_sql(col: str) -> str:
    return f"""SELECT '{col.strip('"')}' AS columna, (SELECT count({col}) FROM lines) AS count, NULL AS mean, NULL AS std,
  NULL AS min, NULL AS max, NULL AS q25, NULL AS q50, NULL AS q75,
  (SELECT count(DISTINCT {col}) FROM lines) AS "unique", v AS top, n AS freq
FROM (SELECT {col} AS v, count(*) AS n FROM lines WHERE {col} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1)"""


@query("describe_all", f"""WITH {LINES}
SELECT *, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq
FROM ({_describe_sql('quantity', 'quantity', 'lines')})
UNION ALL {_mode_sql('titulo')}
UNION ALL {_mode_sql('"MARCA"')}""")
def describe_all(spark, d):
    return _described(D.describe_all(sale_lines(spark, d), ["quantity"], ["titulo", "MARCA"]))


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1")
def value_counts(spark, d):
    return D.value_counts(table(spark, d, "events"), "event_type")


@query("minmax_dates", "SELECT min(l_shipdate) AS desde, max(l_shipdate) AS hasta, count(*) AS filas FROM lineitem")
def minmax_dates(spark, d):
    return D.minmax_dates(table(spark, d, "lineitem"), "l_shipdate")


@query("distinct_values", f'WITH {LINES} SELECT DISTINCT "Periodo" FROM lines')
def distinct_values(spark, d):
    return D.distinct_values(sale_lines(spark, d), "Periodo")


@query("n_distinct", f'WITH {LINES} SELECT count(DISTINCT mail) AS n_mail, count(DISTINCT "MARCA") AS "n_MARCA" FROM lines')
def n_distinct(spark, d):
    return D.n_distinct(sale_lines(spark, d), "mail", "MARCA")


LATEST_BRAND = f"""one AS (SELECT mail, "MARCA" FROM (
  SELECT mail, "MARCA", row_number() OVER (PARTITION BY mail ORDER BY fecha DESC, l_linenumber DESC, product_id DESC,
    l_suppkey DESC, total_actualizado DESC, quantity DESC, bill_id DESC) AS rn FROM lines WHERE tipo_prd_id = 1) WHERE rn = 1)"""


def latest_brand(spark, d) -> DataFrame:
    main = sale_lines(spark, d, account=True).filter("tipo_prd_id = 1").select(
        "mail", "fecha", "MARCA", *TIE)
    return last_per_key(main, ["mail"], ["fecha", *TIE]).select("mail", "MARCA")


_CORR = """top AS (SELECT "MARCA", count(*) AS ids FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10),
inside AS (SELECT pairs.* FROM pairs JOIN top USING ("MARCA")),
total AS (SELECT CAST(count(DISTINCT mail) AS DOUBLE) AS n FROM inside),
joint AS (SELECT x."MARCA" AS a, y."MARCA" AS b, CAST(count(*) AS DOUBLE) AS n_ab FROM inside x JOIN inside y USING (mail) GROUP BY 1, 2)
SELECT s."MARCA" AS a, t."MARCA" AS b, round(CASE WHEN s."MARCA" = t."MARCA" THEN 1.0 ELSE
  (n * COALESCE(n_ab, 0) - s.ids * t.ids) / (sqrt(s.ids * (n - s.ids)) * sqrt(t.ids * (n - t.ids))) END, 6) AS corr
FROM top s CROSS JOIN top t CROSS JOIN total LEFT JOIN joint ON joint.a = s."MARCA" AND joint.b = t."MARCA\""""


@query("onehot_correlation", f"WITH {ACCOUNTS}, {LATEST_BRAND}, pairs AS (SELECT * FROM one), {_CORR}")
def onehot_correlation(spark, d):
    return rounded(D.onehot_correlation(latest_brand(spark, d), "mail", "MARCA"))


@query("onehot_correlation_many", f"""WITH {ACCOUNTS}, pairs AS (SELECT DISTINCT mail, "MARCA" FROM lines WHERE tipo_prd_id = 1), {_CORR}""")
def onehot_correlation_many(spark, d):
    main = sale_lines(spark, d, account=True).filter("tipo_prd_id = 1")
    return rounded(D.onehot_correlation(main, "mail", "MARCA"))


_SHARES = """shares AS (SELECT event_type AS a, CAST(extract('isodow' FROM ts) AS VARCHAR) AS b,
  count(*) / CAST(10 AS DOUBLE) AS corr FROM events GROUP BY 1, 2)"""


def _weekday_counts(spark, d) -> DataFrame:
    day = (F.weekday("ts") + 1).cast("string")
    return table(spark, d, "events").groupBy(F.col("event_type").alias("a"), day.alias("b")).agg(
        (F.count(F.lit(1)) / F.lit(10.0)).alias("corr"))


@query("long_to_wide", f"""WITH {_SHARES}
SELECT a, {", ".join(f"max(CASE WHEN b = '{i}' THEN corr END) AS " + chr(34) + str(i) + chr(34) for i in range(1, 8))}
FROM shares GROUP BY a""")
def long_to_wide(spark, d):
    return D.long_to_wide(_weekday_counts(spark, d), [str(i) for i in range(1, 8)])


@query("matrix_to_long", f"WITH {_SHARES} SELECT a, b, corr FROM shares")
def matrix_to_long(spark, d):
    wide = D.long_to_wide(_weekday_counts(spark, d), [str(i) for i in range(1, 8)])
    return D.matrix_to_long(wide, "a")


@query("matrix_to_long_unlabelled", """SELECT CAST(isodow(ts) AS VARCHAR) AS a, CAST(user_id % 7 + 1 AS VARCHAR) AS b,
  count(*) / 10.0::DOUBLE AS corr FROM events GROUP BY 1, 2""")
def matrix_to_long_unlabelled(spark, d):
    """A square matrix whose rows follow the order of the columns, without labels of their own."""
    days = [str(i) for i in range(1, 8)]
    counts = table(spark, d, "events").groupBy(
        (F.weekday("ts") + 1).cast("string").alias("a"), (F.col("user_id") % 7 + 1).cast("string").alias("b")).agg(
        (F.count(F.lit(1)) / F.lit(10.0)).alias("corr"))
    wide = D.long_to_wide(counts, days)
    return D.matrix_to_long(wide.select(*days, (F.col("a").cast("int") - 1).alias("fila")))


@query("distribution_profile", f"""WITH {LINES}, span AS (SELECT min(x) AS lo, max(x) AS hi FROM (
    SELECT CAST(total_actualizado AS DOUBLE) AS x FROM lines)),
binned AS (SELECT "MARCA", CAST(least(floor((CAST(total_actualizado AS DOUBLE) - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin,
  lo, hi FROM lines, span),
quart AS (SELECT "MARCA", round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS q50,
  round(quantile_cont(x, 0.75), 6) AS q75 FROM (SELECT "MARCA", CAST(total_actualizado AS DOUBLE) AS x FROM lines) GROUP BY 1)
SELECT b."MARCA", b.bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS desde, count(*) AS n, q25, q50, q75
FROM binned b JOIN quart USING ("MARCA") GROUP BY ALL""")
def distribution_profile(spark, d):
    return rounded(D.distribution_profile(sale_lines(spark, d), "total_actualizado", "MARCA"))


@query("density_profile", f"""WITH {LINES}, vals AS (SELECT "MARCA", CAST(total_actualizado AS DOUBLE) AS v FROM lines),
span AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
hist AS (SELECT "MARCA", lo, hi, least(floor((v - lo) / ((hi - lo) / 256)), 255) AS bin, count(*) AS n FROM vals, span GROUP BY ALL),
labels AS (SELECT "MARCA", count(*) AS total, stddev_samp(v) * pow(count(*), -0.2::DOUBLE) AS h FROM vals GROUP BY 1 HAVING stddev_samp(v) > 0),
laid AS (SELECT hist.*, total, h, CAST(punto AS INTEGER) AS punto, lo + punto * ((hi - lo) / 63) AS x, lo + (bin + 0.5::DOUBLE) * ((hi - lo) / 256) AS m
  FROM hist JOIN labels USING ("MARCA"), range(64) t(punto))
SELECT "MARCA", punto, round(x, 6) AS x, round(sum(n * exp(-((x - m) / h) * ((x - m) / h) / 2) / (total * h * sqrt(2.0::DOUBLE * pi()))), 14) AS densidad
FROM laid GROUP BY "MARCA", punto, x""")
def density_profile(spark, d):
    curve = D.density_profile(sale_lines(spark, d), "total_actualizado", "MARCA")
    return rounded(rounded(curve, 6, "x"), 14, "densidad")


# --- snapshot ------------------------------------------------------------------------------

def _contents(distinct: bool) -> str:
    if not distinct:
        return """contents AS (SELECT mail, "Periodo", string_agg(titulo, ', ' ORDER BY fecha, titulo) AS contenido
  FROM lines GROUP BY 1, 2)"""
    return """firsts AS (SELECT mail, "Periodo", titulo, min(fecha) AS f FROM lines GROUP BY ALL),
contents AS (SELECT mail, "Periodo", string_agg(titulo, ', ' ORDER BY f, titulo) AS contenido FROM firsts GROUP BY 1, 2)"""


RANKED = """ranked AS (SELECT *, row_number() OVER (PARTITION BY mail ORDER BY "Periodo" DESC) AS orden FROM contents)"""


@query("period_contents", f"WITH {LINES}, {_contents(True)} SELECT * FROM contents")
def period_contents(spark, d):
    return N.period_contents(sale_lines(spark, d))


@query("period_contents_v1", f"WITH {LINES}, {_contents(False)} SELECT * FROM contents")
def period_contents_v1(spark, d):
    return N.period_contents(sale_lines(spark, d), distinct=False)


@query("nth_last_contents", f"""WITH {ACCOUNTS}, {_contents(True)}, {RANKED}
SELECT mail, contenido, orden::INTEGER AS orden FROM ranked WHERE orden <= 2""")
def nth_last_contents(spark, d):
    lines = sale_lines(spark, d, account=True)
    parts = [N.nth_last_contents(lines, n).withColumn("orden", F.lit(n)) for n in (1, 2)]
    return parts[0].unionByName(parts[1])


@query("last_two_contents", f"""WITH {ACCOUNTS}, {_contents(False)}, {RANKED}
SELECT mail, max(CASE WHEN orden = 1 THEN contenido END) AS "Contenido Ultima Compra",
  max(CASE WHEN orden = 2 THEN contenido END) AS "Contenido Ante Ultima Compra" FROM ranked GROUP BY mail""")
def last_two_contents(spark, d):
    return N.last_two_contents(sale_lines(spark, d, account=True), distinct=False)


_MONO = """single AS (SELECT mail FROM features WHERE "Multimarca" = 0),
monos AS (SELECT mail, string_agg(titulo, ', ' ORDER BY f, titulo) AS producto_que_consume,
    '[' || string_agg('''' || titulo || '''', ' ' ORDER BY f, titulo) || ']' AS lista FROM (
  SELECT mail, titulo, min(fecha) AS f FROM attributed
  WHERE tipo_prd_id = 1 AND mail IN (SELECT mail FROM single) GROUP BY 1, 2) GROUP BY mail)"""


@query("products_of_monobrand", f"""WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES}, {_MONO}
SELECT mail, producto_que_consume, lista FROM monos""")
def products_of_monobrand(spark, d):
    lines = account_lines(spark, d)
    feats = X.customer_features(lines)
    joined = N.products_of_monobrand(lines, feats)
    listed = N.products_of_monobrand(lines, feats, style="list")
    return joined.join(listed.withColumnRenamed("producto_que_consume", "lista"), "mail")


@query("segment_join", f"""WITH {ACCOUNTS}, {ATTRIBUTED}, {FEATURES}, {RFM}, {KEPT}
SELECT labelled.*, kept.* EXCLUDE (mail) FROM labelled JOIN kept USING (mail)""")
def segment_join(spark, d):
    lines = account_lines(spark, d)
    return N.segment_join(X.customer_features(lines), M.iqr_filter(staged(M.rfm(lines), "rfm")))


# --- gaps and transitions ------------------------------------------------------------------

def _gap_sql(keys: str) -> str:
    return f"""gaps AS (SELECT *, CASE WHEN g IS NULL THEN 'Primera / Única Compra' WHEN g <= 30 THEN 'Gap Corto'
    WHEN g <= 90 THEN 'Gap Medio' WHEN g <= 183 THEN 'Gap Largo' ELSE 'Gap Muy Largo' END AS segmento_gap,
    g AS gap_entre_compras FROM (
  SELECT *, CAST(date_sub('day', lag(ultima_compra) OVER (PARTITION BY {keys} ORDER BY ultima_compra, fecha_segmentacion),
    ultima_compra) AS INTEGER) AS g FROM snaps))"""


_GAPCOLS = "mail, fecha_segmentacion, rfm, ultima_compra, gap_entre_compras, segmento_gap"


@query("purchase_gap", f"WITH {SNAPSHOTS}, {_gap_sql('mail')} SELECT {_GAPCOLS} FROM gaps")
def purchase_gap(spark, d):
    return G.purchase_gap(weekly_snapshots(spark, d))


@query("purchase_gap_split", f"WITH {SNAPSHOTS}, {_gap_sql('mail')} SELECT {_GAPCOLS} FROM gaps")
def purchase_gap_split(spark, d):
    """With every customer treated as a hot one."""
    return G.purchase_gap(weekly_snapshots(spark, d), hot_rows=0)


@query("purchase_gap_within_label", f"WITH {SNAPSHOTS}, {_gap_sql('mail, rfm')} SELECT {_GAPCOLS} FROM gaps")
def purchase_gap_within_label(spark, d):
    return G.purchase_gap(weekly_snapshots(spark, d), within_label=True)


@query("purchase_gap_nulls", f"""WITH {SNAPSHOTS.replace("snaps AS", "whole AS", 1)}, snaps AS (SELECT * REPLACE (
  CASE CAST(mail AS INTEGER) % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE mail END AS mail) FROM whole), {_gap_sql('mail')}
SELECT mail, fecha_segmentacion, ultima_compra, CASE WHEN mail IS NOT NULL THEN gap_entre_compras END AS gap_entre_compras,
  CASE WHEN mail IS NULL THEN 'Primera / Única Compra' ELSE segmento_gap END AS segmento_gap FROM gaps""")
def purchase_gap_nulls(spark, d):
    """Null customers have no purchases before; the customer '' is one like others."""
    code = F.col("mail").cast("int") % 4
    snaps = weekly_snapshots(spark, d).withColumn("mail", F.when(code == 1, "").when(code != 0, F.col("mail")))
    ranked = snaps.select("mail", "fecha_segmentacion", "ultima_compra")
    return G.purchase_gap(ranked)


@query("gap_distribution", f"""WITH {SNAPSHOTS}, {_gap_sql('mail')}
SELECT rfm, segmento_gap, count(DISTINCT mail) AS cantidad_de_clientes, count(*) AS filas FROM gaps GROUP BY 1, 2""")
def gap_distribution(spark, d):
    return G.gap_distribution(G.purchase_gap(weekly_snapshots(spark, d)))


@query("gap_summary", f"""WITH {SNAPSHOTS}, {_gap_sql('mail')}
SELECT * EXCLUDE (columna) FROM ({_describe_sql('gap_entre_compras', 'g', 'gaps', 'rfm')})""")
def gap_summary(spark, d):
    return _described(G.gap_summary(staged(G.purchase_gap(weekly_snapshots(spark, d)), "gaps")))


_PREV = """moves AS (SELECT *, lag(rfm) OVER (PARTITION BY mail ORDER BY fecha_segmentacion, event_id) AS rfm_anterior
  FROM states)"""


@query("previous_state", f"WITH {STATES}, {_PREV} SELECT * FROM moves")
def previous_state(spark, d):
    return T.previous_state(states(spark, d), tie=("event_id",))


@query("previous_state_split", f"WITH {STATES}, {_PREV} SELECT * FROM moves")
def previous_state_split(spark, d):
    """With every customer treated as a hot one."""
    return T.previous_state(states(spark, d), tie=("event_id",), hot_rows=0)


EDGES = """edges AS (SELECT rfm_anterior, rfm, count(*) AS cantidad FROM moves WHERE rfm_anterior IS NOT NULL
  GROUP BY 1, 2)"""


@query("transition_edges", f"WITH {STATES}, {_PREV}, {EDGES} SELECT * FROM edges")
def transition_edges(spark, d):
    return T.transition_edges(states(spark, d), tie=("event_id",))


@query("transition_nodes", "SELECT event_type AS rfm, count(*) AS cantidad FROM events GROUP BY 1")
def transition_nodes(spark, d):
    return T.transition_nodes(states(spark, d))


_LABELS = ("click", "error", "purchase", "signup", "view")
MATRIX = ("SELECT rfm_anterior, " + ", ".join(
    f"round(COALESCE(sum(CASE WHEN rfm = '{x}' THEN cantidad END), 0) / sum(cantidad)::DOUBLE, 6) AS \"{x}\""
    for x in _LABELS) + " FROM edges GROUP BY 1")


@query("transition_matrix", f"WITH {STATES}, {_PREV}, {EDGES} {MATRIX}")
def transition_matrix(spark, d):
    edges = T.transition_edges(states(spark, d), tie=("event_id",))
    return rounded(T.transition_matrix(edges))
