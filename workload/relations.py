"""Sources, filters, joins, sets, sorts."""

from pyspark.sql import functions as F

from clientela.operators import lines as L
from clientela.operators import relational as R
from clientela.operators.rfm import date_anchor
from clientela.sources import files
from clientela.sources.staging import stage_path, staged
from clientela.sources.tables import read_table
from workload.base import (
    ACCOUNTS, CATALOG, LATEST, LINES, PRICE_LOG, PRICE_TIE, SHOP, SNAPSHOTS, TIE, TIE_SQL, catalog, price_log,
    query, sale_lines, shop, table, weekly_snapshots)

MONTH = "2001-06"
_LCOLS = ("mail", "post_id", "product_id", "quantity", "fecha", "total_actualizado", "type",
          "l_linenumber", "l_suppkey")
_LSQL = ", ".join(_LCOLS)


# --- sources and sinks ---------------------------------------------------------------------

# A text with line breaks, quotes, outer blanks, backslashes, empty or null, by a number.
_TEXT = """CASE {n} % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' || {t} WHEN 3 THEN {t} || chr(10) || {t} || ' '
  WHEN 4 THEN '"' || {t} || '",' WHEN 5 THEN {t} || chr(92) || 'n' WHEN 6 THEN chr(92) || 'N' ELSE {t} END AS nota"""


def noted(df, number: str, text: str):
    return df.select("*", F.expr(_TEXT.format(n=number, t=text)))

@query("read_table", "SELECT * FROM customer")
def read_table_(spark, d):
    return read_table(spark, f"{d}/customer.parquet")


@query("orders_in_month", f"""WITH {SHOP}
SELECT * FROM s_orders WHERE post_type = 'shop_order' AND post_status = 'wc-bill'
  AND post_date >= TIMESTAMP '1998-03-01' AND post_date < TIMESTAMP '1998-04-01'""")
def orders_in_month(spark, d):
    return L.orders_in_month(shop(spark, d)["orders"], "1998-03", ordered=True)


@query("eav_attribute", f"""WITH {SHOP}
SELECT post_id, meta_value AS mail FROM s_attributes WHERE meta_key = '_billing_email'""")
def eav_attribute(spark, d):
    return L.eav_attribute(shop(spark, d)["attributes"], "_billing_email", "mail")


@query("eav_pivot", f"""WITH {SHOP}
SELECT post_id, max(CASE WHEN meta_key = '_billing_email' THEN meta_value END) AS "_billing_email",
  max(CASE WHEN meta_key = 'tipo_prd_id' THEN meta_value END) AS tipo_prd_id
FROM s_attributes GROUP BY post_id""")
def eav_pivot(spark, d):
    return L.eav_pivot(shop(spark, d)["attributes"], ["_billing_email", "tipo_prd_id"])


@query("fetch_by_keys", f"""WITH {SHOP}
SELECT * FROM s_bills WHERE post_id IN (SELECT "ID" FROM s_orders WHERE post_status = 'wc-pending')""")
def fetch_by_keys(spark, d):
    t = shop(spark, d)
    keys = t["orders"].filter("post_status = 'wc-pending'").select(F.col("ID").alias("post_id"))
    return R.fetch_by_keys(t["bills"], keys, "post_id")


_NOTED = f"WITH {LINES} SELECT {_LSQL}, {_TEXT.format(n='(l_linenumber + product_id)', t='type')} FROM lines"
_NOTED_SNAPS = f"{_TEXT.format(n='CAST(mail AS INTEGER)', t='rfm')}"


@query("read_csv_snapshot", _NOTED)
def read_csv_snapshot(spark, d):
    """Written with an index column, as older snapshots have one, and read back."""
    df = noted(sale_lines(spark, d).select(*_LCOLS), "(l_linenumber + product_id)", "type")
    path = stage_path(spark, "csv")
    files.write_snapshot(df.select(F.monotonically_increasing_id().alias("Unnamed: 0"), "*"), path)
    return files.read_csv_snapshot(spark, path, df.schema)


@query("write_snapshot", _NOTED)
def write_snapshot(spark, d):
    df = noted(sale_lines(spark, d).select(*_LCOLS), "(l_linenumber + product_id)", "type")
    path = stage_path(spark, "tsv")
    files.write_snapshot(df, path, sep="\t")
    return files.read_csv_snapshot(spark, path, df.schema, sep="\t")


@query("write_by_segment", f"WITH {SNAPSHOTS} SELECT *, {_NOTED_SNAPS} FROM snaps")
def write_by_segment(spark, d):
    """Written twice, the first time with a label that is gone then."""
    df = noted(weekly_snapshots(spark, d), "CAST(mail AS INT)", "rfm")
    path = stage_path(spark, "segments")
    files.write_by_segment(df.withColumn("rfm", F.lit("gone")), path)
    files.write_by_segment(df, path)
    return files.read_csv_snapshot(spark, path, df.schema)


@query("publish_latest", f"WITH {SNAPSHOTS} SELECT *, {_NOTED_SNAPS}, 2 AS copias FROM snaps")
def publish_latest(spark, d):
    df = noted(weekly_snapshots(spark, d), "CAST(mail AS INT)", "rfm")
    archive, latest = stage_path(spark, "archive"), stage_path(spark, "latest")
    files.publish(df.limit(1), latest)
    files.publish_latest(df, archive, latest)
    both = spark.read.parquet(archive).unionByName(files.read_csv_snapshot(spark, files.published(spark, latest), df.schema))
    return both.groupBy(*df.columns).agg(F.count(F.lit(1)).cast("int").alias("copias"))


@query("with_history", f"""WITH {LINES}
SELECT 'ambas' AS caso, count(*) AS n FROM lines
UNION ALL SELECT 'actual', count(*) FROM lines WHERE "Periodo" = '{MONTH}'
UNION ALL SELECT 'historia', count(*) FROM lines WHERE "Periodo" <> '{MONTH}'""")
def with_history(spark, d):
    lines = sale_lines(spark, d)
    now, old = lines.filter(F.col("Periodo") == MONTH), lines.filter(F.col("Periodo") != MONTH)
    cases = {"ambas": R.with_history(now, old), "actual": R.with_history(now, None),
             "historia": R.with_history(None, old)}
    out = None
    for name, df in cases.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("caso"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# --- filters -------------------------------------------------------------------------------

@query("drop_returns", f"""WITH {LINES}
SELECT {_LSQL} FROM lines WHERE type IS DISTINCT FROM 'pmi-credit-note' AND quantity > 0""")
def drop_returns(spark, d):
    return R.drop_returns(sale_lines(spark, d)).select(*_LCOLS)


@query("require", """
SELECT * FROM (SELECT event_id, CASE WHEN value > 10 THEN value END AS value,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events)
WHERE value IS NOT NULL AND event_type IS NOT NULL""")
def require(spark, d):
    df = table(spark, d, "events").select(
        "event_id", F.when(F.col("value") > 10, F.col("value")).alias("value"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"))
    return R.require(df, ["value", "event_type"])


@query("active_customers", f"""WITH {ACCOUNTS}
SELECT {_LSQL} FROM lines WHERE mail IN (
  SELECT mail FROM lines GROUP BY mail HAVING max(fecha) >= TIMESTAMP '2001-10-31' - INTERVAL 365 DAY)""")
def active_customers(spark, d):
    return R.active_customers(sale_lines(spark, d, account=True), "2001-10-31").select(*_LCOLS)


@query("split_by_kind", f"""WITH {LINES}
SELECT 'main' AS grupo, {_LSQL} FROM lines WHERE tipo_prd_id = 1
UNION ALL SELECT 'otros', {_LSQL} FROM lines WHERE tipo_prd_id = 2""")
def split_by_kind(spark, d):
    lines = sale_lines(spark, d)
    parts = [R.split_by_kind(lines, k).select(F.lit(n).alias("grupo"), *_LCOLS)
             for k, n in ((1, "main"), (2, "otros"))]
    return parts[0].unionByName(parts[1])


@query("customer_lookup", f"""WITH {LINES}
SELECT q.mail, (SELECT CAST(date_sub('day', max(l.fecha), (SELECT max(fecha) FROM lines)) AS INTEGER)
    FROM lines l WHERE l.mail = q.mail) AS "Recencia",
  EXISTS (SELECT 1 FROM lines l WHERE l.mail = q.mail) AS found
FROM (VALUES ('17'), ('nadie')) q(mail)""")
def customer_lookup(spark, d):
    from clientela.operators.rfm import rfm
    scores = rfm(sale_lines(spark, d))
    return R.customer_lookup(scores, "17").unionByName(R.customer_lookup(scores, "nadie"))


@query("current_snapshot", f"""WITH {SNAPSHOTS}
SELECT * FROM snaps WHERE fecha_segmentacion = DATE '2024-01-15'""")
def current_snapshot(spark, d):
    return R.current_snapshot(weekly_snapshots(spark, d), "2024-01-15")


@query("segment_subset", f"WITH {SNAPSHOTS} SELECT * FROM snaps WHERE rfm = 'purchase'")
def segment_subset(spark, d):
    return R.segment_subset(weekly_snapshots(spark, d), "purchase")


# --- joins ---------------------------------------------------------------------------------

@query("assemble_lines", f"""WITH {SHOP}
SELECT i.bill_id, i.product_id, i.quantity, p.titulo, p.descripcion, CAST(k.meta_value AS INTEGER) AS tipo_prd_id,
  b.post_id, b.type, b.fecha, m.meta_value AS mail
FROM s_items i JOIN s_bills b USING (bill_id) JOIN s_orders o ON o."ID" = b.post_id
LEFT JOIN s_attributes m ON m.post_id = o."ID" AND m.meta_key = '_billing_email'
LEFT JOIN s_products p ON p.product_id = i.product_id
LEFT JOIN s_attributes k ON k.post_id = i.product_id AND k.meta_key = 'tipo_prd_id'""")
def assemble_lines(spark, d):
    t = shop(spark, d)
    kinds = L.eav_attribute(t["attributes"], "tipo_prd_id", "tipo_prd_id")
    return L.assemble_lines(
        t["orders"], L.eav_attribute(t["attributes"], "_billing_email", "mail"), t["bills"],
        t["items"], t["products"], kinds.withColumnRenamed("post_id", "product_id"))


@query("join_dedup_right", """
SELECT c_custkey, c_name, o_orderkey, o_totalprice FROM customer LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
    FROM orders) WHERE rn = 1) ON c_custkey = o_custkey""")
def join_dedup_right(spark, d):
    orders = table(spark, d, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate")
    return R.join_dedup_right(table(spark, d, "customer").select("c_custkey", "c_name"), orders,
                              "c_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("enrich_catalog", f"""WITH {LINES}, {CATALOG}
SELECT l.post_id, l.product_id, l.l_linenumber, l.l_suppkey, l.quantity, l.total_actualizado, l.t AS titulo,
  COALESCE(c."MARCA", 'otros') AS "MARCA", COALESCE(c."CATEGORÍA", 'otros') AS "CATEGORÍA"
FROM (SELECT *, CASE WHEN titulo LIKE '%ring' THEN titulo || ' x' ELSE titulo END AS t FROM lines) l
LEFT JOIN catalog c ON c.titulo = l.t""")
def enrich_catalog(spark, d):
    lines = sale_lines(spark, d).select("post_id", "product_id", "l_linenumber", "l_suppkey",
                                        "quantity", "total_actualizado", "titulo")
    other = F.when(F.col("titulo").like("%ring"), F.concat("titulo", F.lit(" x"))).otherwise(F.col("titulo"))
    lines = lines.withColumn("titulo", other)  # titles that the catalogue lacks
    return L.enrich_catalog(lines, catalog(spark, d))


@query("attach_latest_price", f"""WITH {LINES}, {PRICE_LOG}, {LATEST}
SELECT l.post_id, l.product_id, l.l_linenumber, l.l_suppkey, l.quantity, l.fecha,
  COALESCE(p.precio, 0) AS precio, CAST(COALESCE(p.precio, 0) * l.quantity AS DOUBLE) AS total_actualizado
FROM lines l LEFT JOIN latest p USING (product_id)""")
def attach_latest_price(spark, d):
    from clientela.operators.pricing import latest_price
    lines = sale_lines(spark, d).select("post_id", "product_id", "l_linenumber", "l_suppkey",
                                        "quantity", "fecha")
    return L.attach_latest_price(lines, latest_price(price_log(spark, d), PRICE_TIE))


@query("semi_join", """
SELECT c_custkey, c_name FROM customer SEMI JOIN (SELECT * FROM orders WHERE o_totalprice > 480000) o
ON c_custkey = o.o_custkey""")
def semi_join(spark, d):
    keys = table(spark, d, "orders").filter("o_totalprice > 480000").select(
        F.col("o_custkey").alias("c_custkey"))
    return R.semi_join(table(spark, d, "customer").select("c_custkey", "c_name"), keys, "c_custkey")


@query("anti_join", """
SELECT c_custkey, c_name FROM customer ANTI JOIN (SELECT * FROM orders WHERE o_totalprice > 480000) o
ON c_custkey = o.o_custkey""")
def anti_join(spark, d):
    keys = table(spark, d, "orders").filter("o_totalprice > 480000").select(
        F.col("o_custkey").alias("c_custkey"))
    return R.anti_join(table(spark, d, "customer").select("c_custkey", "c_name"), keys, "c_custkey")


@query("membership_flag", f"""WITH {ACCOUNTS}
SELECT mail, max(CASE WHEN tipo_prd_id = 2 THEN 1 ELSE 0 END) AS otros,
  max(CASE WHEN type = 'pmi-credit-note' THEN 1 ELSE 0 END) AS devuelve FROM lines GROUP BY mail""")
def membership_flag(spark, d):
    return R.membership_flag(sale_lines(spark, d, account=True), "mail", {
        "otros": F.col("tipo_prd_id") == 2, "devuelve": F.col("type") == "pmi-credit-note"})


@query("lookup_join", """
SELECT c_custkey, o.primera FROM customer LEFT JOIN (
  SELECT o_custkey, min(o_orderdate) AS primera FROM orders GROUP BY 1) o ON c_custkey = o.o_custkey""")
def lookup_join(spark, d):
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("primera"))
    return R.lookup_join(table(spark, d, "customer").select("c_custkey"), first, "c_custkey")


@query("broadcast_scalar", f"""WITH {LINES}
SELECT post_id, product_id, l_linenumber, l_suppkey, quantity, total_actualizado,
  CAST(date_sub('day', fecha, (SELECT max(fecha) FROM lines)) AS INTEGER) AS dias FROM lines""")
def broadcast_scalar(spark, d):
    from clientela.functions.scalars import elapsed_days
    lines = sale_lines(spark, d)
    latest = date_anchor(table(spark, d, "lineitem").withColumnRenamed("l_shipdate", "fecha"))
    return R.broadcast_scalar(lines, latest).select(
        "post_id", "product_id", "l_linenumber", "l_suppkey", "quantity", "total_actualizado",
        elapsed_days(F.col("fecha"), F.col("max_fecha")).alias("dias"))


# --- windows, sorts, sets ------------------------------------------------------------------

NETTED = f"""WITH {LINES}, seen AS (
  SELECT *, lead(type) OVER w AS nt, lead("MARCA") OVER w AS nm, lead(fecha) OVER w AS nf,
    lead(quantity) OVER w AS nq FROM lines
  WINDOW w AS (PARTITION BY post_id ORDER BY "MARCA", fecha, {TIE_SQL}))
SELECT post_id, product_id, "MARCA", l_linenumber, l_suppkey, type, fecha, total_actualizado,
  CASE WHEN nt = 'pmi-credit-note' AND nm = "MARCA" AND nf > fecha THEN quantity - nq ELSE quantity END AS quantity
FROM seen"""
_NET_COLS = ("post_id", "product_id", "MARCA", "l_linenumber", "l_suppkey", "type", "fecha",
             "total_actualizado", "quantity")


@query("net_credit_notes", NETTED)
def net_credit_notes(spark, d):
    lines = sale_lines(spark, d).select("bill_id", *_NET_COLS)
    return L.net_credit_notes(lines, text="MARCA", product="MARCA", tie=TIE).select(*_NET_COLS)


@query("net_credit_notes_split", NETTED)
def net_credit_notes_split(spark, d):
    """With every recognised group treated as a hot one, on stored lines as in the monthly run."""
    lines = staged(sale_lines(spark, d).select("bill_id", *_NET_COLS), "lines")
    return L.net_credit_notes(lines, text="MARCA", product="MARCA", tie=TIE, hot_rows=0).select(*_NET_COLS)


@query("net_credit_notes_nulls", NETTED.replace("FROM lines", "FROM loose").replace("seen AS", """loose AS (
  SELECT * REPLACE (CASE WHEN post_id % 3 = 0 THEN NULL ELSE post_id END AS post_id) FROM lines), seen AS""", 1).replace(
    "CASE WHEN nt", "CASE WHEN post_id IS NOT NULL AND nt"))
def net_credit_notes_nulls(spark, d):
    """A third of the lines have no order: they net nothing."""
    lines = sale_lines(spark, d).select("bill_id", *_NET_COLS).withColumn(
        "post_id", F.when(F.col("post_id") % 3 != 0, F.col("post_id")))
    return L.net_credit_notes(lines, text="MARCA", product="MARCA", tie=TIE).select(*_NET_COLS)


@query("last_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""")
def last_per_key(spark, d):
    from clientela.operators.ordered import last_per_key as last
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def first_per_key(spark, d):
    from clientela.operators.ordered import first_per_key as first
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("sort_rows", "SELECT * FROM customer ORDER BY c_mktsegment, c_acctbal, c_custkey")
def sort_rows(spark, d):
    return R.sort_rows(table(spark, d, "customer"), "c_mktsegment", "c_acctbal", "c_custkey")


@query("preview", "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5")
def preview(spark, d):
    return R.preview(table(spark, d, "orders"), 5, "o_orderdate", "o_orderkey")


@query("append_history", f"""WITH {LINES}
SELECT post_id, product_id, quantity, CAST(NULL AS INTEGER) AS l_linenumber, "Periodo" FROM lines WHERE "Periodo" < '{MONTH}'
UNION ALL SELECT post_id, product_id, quantity, l_linenumber, NULL FROM lines WHERE "Periodo" >= '{MONTH}'""")
def append_history(spark, d):
    lines = sale_lines(spark, d)
    base = ("post_id", "product_id", "quantity")
    old = lines.filter(F.col("Periodo") < MONTH).select(*base, "Periodo")
    new = lines.filter(F.col("Periodo") >= MONTH).select(*base, "l_linenumber")
    return R.append_history(old, new)


@query("upsert_period", f"""WITH {LINES}
SELECT post_id, product_id, l_linenumber, l_suppkey, total_actualizado, "Periodo",
  CASE WHEN "Periodo" >= '{MONTH}' THEN quantity + 1 ELSE quantity END AS quantity FROM lines""")
def upsert_period(spark, d):
    cols = ("post_id", "product_id", "l_linenumber", "l_suppkey", "total_actualizado", "Periodo", "quantity")
    lines = sale_lines(spark, d).select(*cols)
    new = lines.filter(F.col("Periodo") >= MONTH).withColumn("quantity", F.col("quantity") + 1)
    once = R.upsert_period(lines, new)
    return R.upsert_period(once, new)


@query("upsert_period_nulls", f"""WITH {LINES}
SELECT post_id, product_id, l_linenumber, l_suppkey, total_actualizado, CASE WHEN "Periodo" < '{MONTH}' THEN "Periodo" END AS "Periodo",
  CASE WHEN "Periodo" >= '{MONTH}' THEN quantity + 1 ELSE quantity END AS quantity FROM lines""")
def upsert_period_nulls(spark, d):
    """A null period is replaced by a null period, also twice."""
    cols = ("post_id", "product_id", "l_linenumber", "l_suppkey", "total_actualizado", "Periodo", "quantity")
    lines = sale_lines(spark, d).select(*cols).withColumn("Periodo", F.when(F.col("Periodo") < MONTH, F.col("Periodo")))
    new = lines.filter(F.col("Periodo").isNull()).withColumn("quantity", F.col("quantity") + 1)
    return R.upsert_period(R.upsert_period(lines, new), new)


@query("dedup", f"WITH {LINES} SELECT DISTINCT mail, fecha FROM lines")
def dedup(spark, d):
    return R.dedup(sale_lines(spark, d), ["mail", "fecha"])


@query("align_columns", """
SELECT o_orderkey AS post_id, CAST(NULL AS VARCHAR) AS mail, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders""")
def align_columns(spark, d):
    from pyspark.sql import types as T
    schema = (T.StructType().add("post_id", "long").add("mail", "string")
              .add("total", T.DecimalType(18, 2)))
    orders = table(spark, d, "orders").select(F.col("o_totalprice").alias("total"),
                                              F.col("o_orderkey").alias("post_id"))
    return R.align_columns(orders, schema)
