"""Scalar rules: calendar, coercions, line attributes, labels."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions import scalars as S
from clientela.operators import relational as R
from workload.base import LINES, query, sale_lines, table


def texts(spark: SparkSession, d: str) -> DataFrame:
    """Product texts with sizes, box spellings, escapes and missing descriptions."""
    size = F.col("p_size")
    mark = (F.when(size % 5 == 0, "Box").when(size % 5 == 1, "BOX").when(size % 5 == 2, "bOx")
            .when(size % 5 == 3, "box amp; co").otherwise("soft"))
    return table(spark, d, "part").select(
        "p_partkey", size.alias("p_size"), F.col("p_name").alias("titulo"),
        F.when(size != 7, F.concat(mark, F.lit(" "), size.cast("string"))).alias("descripcion"),
        F.when(F.col("p_type").isin("PROMO", "STANDARD"), 1).otherwise(2).alias("tipo_prd_id"))


TEXTS = """texts AS (
  SELECT p_partkey, p_size, p_name AS titulo,
    CASE WHEN p_size <> 7 THEN CASE p_size % 5 WHEN 0 THEN 'Box' WHEN 1 THEN 'BOX' WHEN 2 THEN 'bOx'
      WHEN 3 THEN 'box amp;' || chr(160) || 'co' ELSE 'soft' END || ' ' || CAST(p_size AS VARCHAR)
      END AS descripcion,
    CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 1 ELSE 2 END AS tipo_prd_id
  FROM part)"""

_TAG = ("list_extract(['ENE','FEB','MAR','ABR','MAY','JUN','JUL','AGO','SEP','OCT','NOV','DIC'], "
        "CAST(month({0}) AS INTEGER)) || '_' || CAST(year({0}) AS VARCHAR)")
_PREV = "CAST(date_trunc('month', p) AS DATE) - 1"


@query("run_calendar", f"""
SELECT o_orderkey, p AS process_date, strftime(p, '%Y-%m') AS process_month,
  {_TAG.format('p')} AS process_tag, strftime({_PREV}, '%Y-%m') AS previous_month,
  {_TAG.format(_PREV)} AS previous_tag
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - 1 AS p FROM orders)""")
def run_calendar(spark, d):
    cal = S.run_calendar(F.col("o_orderdate"))
    return table(spark, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in cal.items()])


@query("coerce_int", """
SELECT p_partkey, CAST(TRY_CAST(substr(p_brand, 7) AS BIGINT) AS BIGINT) AS marca,
  COALESCE(CAST(trunc(TRY_CAST(p_name AS DOUBLE)) AS BIGINT), -1) AS nombre,
  CAST(trunc(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE)) AS BIGINT) AS precio,
  CAST(p_size AS BIGINT) AS talle
FROM part""")
def coerce_int(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", S.coerce_int(F.substring("p_brand", 7, 9)).alias("marca"),
        S.coerce_int(F.col("p_name"), -1).alias("nombre"),
        S.coerce_int(F.col("p_retailprice").cast("decimal(18,2)").cast("string")).alias("precio"),
        S.coerce_int(F.col("p_size"), strict=True).alias("talle"))


@query("coerce_double", """
SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,2))::DOUBLE AS precio,
  TRY_CAST(p_name AS DOUBLE) AS nombre FROM part""")
def coerce_double(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        S.coerce_double(F.col("p_retailprice").cast("decimal(18,2)")).alias("precio"),
        S.coerce_double(F.col("p_name")).alias("nombre"))


@query("coerce_ts", """
SELECT o_orderkey, date_trunc('day', o_orderdate)::TIMESTAMP AS iso,
  date_trunc('day', o_orderdate)::TIMESTAMP AS varios,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS malo
FROM orders""")
def coerce_ts(spark, d):
    day = F.date_format("o_orderdate", "dd/MM/yyyy")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, d, "orders").select(
        "o_orderkey", S.coerce_ts(iso).alias("iso"),
        S.coerce_ts(F.when(F.col("o_orderkey") % 2 == 0, day).otherwise(iso),
                    "yyyy-MM-dd", "dd/MM/yyyy").alias("varios"),
        S.coerce_ts(F.when(F.col("o_orderstatus") == "F", F.concat(iso, F.lit(" hora")))
                    .otherwise(iso)).alias("malo"))


@query("full_text", f"""WITH {TEXTS}
SELECT p_partkey, COALESCE(titulo, '') || ' ' || COALESCE(descripcion, '') AS texto,
  titulo || ' ' || descripcion AS texto_v1 FROM texts""")
def full_text(spark, d):
    title, descr = F.col("titulo"), F.col("descripcion")
    return texts(spark, d).select("p_partkey", S.full_text(title, descr).alias("texto"),
                                  S.full_text(title, descr, False).alias("texto_v1"))


@query("pack_units", f"""WITH {TEXTS}
SELECT p_partkey, COALESCE(u, 1) AS unidad, u AS unidad_v1 FROM (
  SELECT p_partkey, CASE WHEN tipo_prd_id = 2 THEN 1
    WHEN COALESCE(contains(descripcion, '12'), FALSE) THEN 12
    WHEN COALESCE(contains(descripcion, '20'), FALSE) THEN 20
    WHEN COALESCE(contains(descripcion, '10'), FALSE) THEN 10 END AS u FROM texts)""")
def pack_units(spark, d):
    text, kind = F.col("descripcion"), F.col("tipo_prd_id")
    return texts(spark, d).select("p_partkey", S.pack_units(text, kind).alias("unidad"),
                                  S.pack_units(text, kind, None).alias("unidad_v1"))


@query("presentation", f"""WITH {TEXTS}
SELECT p_partkey, CASE WHEN tipo_prd_id = 2 THEN 'Otros Productos'
    WHEN COALESCE(regexp_matches(descripcion, 'Box|BOX|box'), FALSE) THEN 'Box'
    ELSE 'Soft_pack' END AS presentacion,
  CASE WHEN tipo_prd_id = 2 THEN 'Otros Productos' WHEN descripcion IS NULL THEN NULL
    WHEN regexp_matches(descripcion, 'Box|BOX|box') THEN 'Box' ELSE 'Soft_pack' END AS presentacion_v1
FROM texts""")
def presentation(spark, d):
    text, kind = F.col("descripcion"), F.col("tipo_prd_id")
    return texts(spark, d).select("p_partkey", S.presentation(text, kind).alias("presentacion"),
                                  S.presentation(text, kind, None).alias("presentacion_v1"))


def _line_id(df, *cols):
    return df.select("post_id", "product_id", "l_linenumber", "l_suppkey", "quantity",
                     "total_actualizado", *cols)


_ID = "post_id, product_id, l_linenumber, l_suppkey, quantity, total_actualizado"


@query("combo_flag", f"""WITH {LINES}
SELECT {_ID},
  CASE WHEN (quantity < 10 OR quantity % 2 <> 0) AND quantity NOT IN (15, 45, 1) THEN 1 ELSE 0 END AS combo,
  CASE WHEN (quantity < 10 OR quantity % 2 <> 0) AND quantity NOT IN (15, 45) THEN 1 ELSE 0 END AS combo_v1
FROM lines""")
def combo_flag(spark, d):
    qty = F.col("quantity")
    return _line_id(sale_lines(spark, d), S.combo_flag(qty).alias("combo"),
                    S.combo_flag(qty, False).alias("combo_v1"))


@query("period", """
SELECT strftime(l_shipdate, '%Y-%m') AS periodo, count(*) AS n FROM lineitem GROUP BY 1""")
def period(spark, d):
    return (table(spark, d, "lineitem").groupBy(S.period(F.col("l_shipdate")).alias("periodo"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("carton_size", f"""WITH {TEXTS}
SELECT p_partkey, CASE WHEN COALESCE(contains(descripcion, 'Box 20'), FALSE) THEN 15
    WHEN tipo_prd_id = 2 THEN 1 ELSE 10 END AS carton,
  CASE WHEN COALESCE(descripcion = 'Box 20', FALSE) THEN 15 WHEN tipo_prd_id = 1 THEN 10 ELSE 0 END AS carton_v1
FROM texts""")
def carton_size(spark, d):
    text, kind = F.col("descripcion"), F.col("tipo_prd_id")
    return texts(spark, d).select(
        "p_partkey", S.carton_size(kind, text, "Box 20").alias("carton"),
        S.carton_size(kind, text, "Box 20", exact=True).alias("carton_v1"))


@query("carton_count", f"""WITH {LINES}
SELECT {_ID}, CASE WHEN tipo_prd_id = 1 THEN quantity / 10.0::DOUBLE ELSE 0.0::DOUBLE END AS cartones
FROM lines""")
def carton_count(spark, d):
    size = S.carton_size(F.col("tipo_prd_id"), F.col("titulo"), exact=True)
    return _line_id(sale_lines(spark, d), S.carton_count(F.col("quantity"), size).alias("cartones"))


@query("clean_title", f"""WITH {TEXTS}
SELECT p_partkey, replace(replace(descripcion, 'amp;', ''), chr(160), ' ') AS titulo FROM texts""")
def clean_title(spark, d):
    return texts(spark, d).select("p_partkey", S.clean_title(F.col("descripcion")).alias("titulo"))


@query("fill_defaults", f"""WITH {TEXTS}
SELECT p_partkey, COALESCE(descripcion, 'otros') AS descripcion, p_size FROM texts""")
def fill_defaults(spark, d):
    return R.fill_defaults(texts(spark, d), {"descripcion": "otros"}).select(
        "p_partkey", "descripcion", "p_size")


@query("line_value", f"""WITH {LINES}
SELECT {_ID}, CAST(CAST(p_retailprice AS DECIMAL(18,2)) * quantity AS DOUBLE) AS valor
FROM lines JOIN part ON product_id = p_partkey""")
def line_value(spark, d):
    price = table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(18,2)").alias("precio"))
    return _line_id(sale_lines(spark, d).join(price, "product_id"),
                    S.line_value(F.col("precio"), F.col("quantity")).alias("valor"))


@query("unit_price", f"""WITH {LINES}
SELECT {_ID}, CASE WHEN q > 0 THEN CAST(total_actualizado AS DOUBLE) / q ELSE 0.0::DOUBLE END AS precio
FROM (SELECT *, CASE WHEN type = 'pmi-credit-note' THEN 0 ELSE quantity END AS q FROM lines)""")
def unit_price(spark, d):
    qty = F.when(F.col("type") == "pmi-credit-note", 0).otherwise(F.col("quantity"))
    return _line_id(sale_lines(spark, d), S.unit_price(F.col("total_actualizado"), qty).alias("precio"))


@query("replace_values", """
SELECT event_id, CASE event_type WHEN 'signup' THEN 'fidelizado' ELSE event_type END AS rfm,
  CASE event_type WHEN 'signup' THEN 'fidelizado' ELSE 'x' END AS otro, value
FROM events""")
def replace_values(spark, d):
    df = table(spark, d, "events").select(
        "event_id", F.col("event_type").alias("rfm"),
        F.when(F.col("event_type") == "signup", "signup").otherwise("x").alias("otro"), "value")
    return R.replace_values(df, {"signup": "fidelizado"})


@query("map_labels", """
SELECT event_id, CASE event_type WHEN 'purchase' THEN 'compra' WHEN 'view' THEN 'vista' END AS etiqueta,
  CASE event_type WHEN 'purchase' THEN 'compra' WHEN 'view' THEN 'vista' END AS etiqueta_fija
FROM events""")
def map_labels(spark, d):
    codes = {"purchase": "compra", "view": "vista"}
    events = table(spark, d, "events").select("event_id", "event_type")
    mapping = (events.select("event_type").distinct()
               .withColumn("e", S.map_codes(F.col("event_type"), codes)).na.drop())
    return R.map_labels(events, "event_type", mapping, "etiqueta").select(
        "event_id", "etiqueta", S.map_codes(F.col("event_type"), codes).alias("etiqueta_fija"))


@query("pattern_label", f"""WITH {LINES}
SELECT mail, m, ff, CASE WHEN m = 0 AND ff = 1 THEN 'FF - Monomarca' WHEN m = 1 AND ff = 1 THEN 'FF - Multimarca'
  WHEN m = 0 AND ff = 0 THEN 'No FF - Monomarca' WHEN m = 1 AND ff = 0 THEN 'No FF - Multimarca'
  ELSE 'Indefinido' END AS patron
FROM (SELECT mail || '/' || post_id AS mail,
    CASE WHEN count(*) > 9 THEN 2 WHEN count(DISTINCT "MARCA") > 1 THEN 1 ELSE 0 END AS m,
    min(CASE WHEN "CATEGORÍA" = 'FF' THEN 1 ELSE 0 END) AS ff FROM lines GROUP BY 1)""")
def pattern_label(spark, d):
    by = sale_lines(spark, d).groupBy(F.concat_ws("/", "mail", "post_id").alias("mail")).agg(
        F.when(F.count(F.lit(1)) > 9, 2).when(F.count_distinct("MARCA") > 1, 1).otherwise(0).alias("m"),
        F.min(F.when(F.col("CATEGORÍA") == "FF", 1).otherwise(0)).alias("ff"))
    return by.withColumn("patron", S.pattern_label(F.col("m"), F.col("ff")))


@query("gap_bucket", """
SELECT o_orderkey, dias, CASE WHEN dias IS NULL THEN 'Primera / Única Compra' WHEN dias <= 30 THEN 'Gap Corto'
  WHEN dias <= 90 THEN 'Gap Medio' WHEN dias <= 183 THEN 'Gap Largo' ELSE 'Gap Muy Largo' END AS segmento
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F'
    THEN date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 400 END AS dias FROM orders)""")
def gap_bucket(spark, d):
    days = F.when(F.col("o_orderstatus") != "F",
                  (F.datediff("o_orderdate", F.lit("1995-01-01")) % 400).cast("long"))
    return (table(spark, d, "orders").select("o_orderkey", days.alias("dias"))
            .withColumn("segmento", S.gap_bucket(F.col("dias"))))


@query("round_money", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
  (c // 8 + CASE WHEN c % 8 > 4 OR (c % 8 = 4 AND c // 8 % 2 = 1) THEN 1 ELSE 0 END) / 100.0::DOUBLE AS valor
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem)""")
def round_money(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        S.round_money(F.col("l_extendedprice").cast("decimal(18,2)").cast("double") / 8).alias("valor"))


@query("elapsed_days", """
SELECT a.user_id, a.event_id, CAST(date_sub('day', TIMESTAMP '2023-12-31 12:00:00', a.ts) AS INTEGER) AS dias
FROM events a""")
def elapsed_days(spark, d):
    start = F.lit("2023-12-31 12:00:00").cast("timestamp_ntz")
    return table(spark, d, "events").select(
        "user_id", "event_id", S.elapsed_days(start, F.col("ts")).alias("dias"))


@query("snapshot_date", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN CAST(date_trunc('month', ts) AS DATE)
  ELSE CAST(ts AS DATE) END AS fecha FROM events""")
def snapshot_date(spark, d):
    text = (F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM"))
            .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd"))
            .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")))
    return table(spark, d, "events").select("event_id", S.snapshot_date(text).alias("fecha"))
