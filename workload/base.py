"""Query registry, and the projections of the driver tables onto the shop's tables.

Each projection exists twice, as a DataFrame and as a SQL common table expression."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.functions.scalars import period

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TIE = ("l_linenumber", "product_id", "l_suppkey", "total_actualizado", "quantity", "bill_id")


def query(name: str, sql: str | None = None):
    """Register a query and its SQL."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


# Stated schemas spare a footer-reading job per table.
SCHEMAS = {
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{d}/{name}.parquet")


# --- sale lines ----------------------------------------------------------------------------

FEW_ROWS, TASK_ROWS = 2_000_000, 500_000   # of a table that is left to Catalyst; else of a joining task


def pieces(df: DataFrame) -> int:
    """Tasks that join a table, by its rows, which the footers of its files count; 0 where it is small."""
    rows = df.count()
    return rows // TASK_ROWS + 1 if rows > FEW_ROWS else 0


def dealt_join(left: DataFrame, right: DataFrame, key: str, n: int) -> DataFrame:
    """Inner join in `n` tasks, so that what one sorts does not grow with the tables; 0: as Catalyst chooses."""
    if n:
        left, right = left.repartition(n, key), right.repartition(n, key)
    return left.join(right, key)


def sale_lines(spark: SparkSession, d: str, account: bool = False) -> DataFrame:
    """Sale lines. `account` makes one customer of each (customer, order year), which leaves
    few enough lines per customer for brand and category flags to differ."""
    who = "CAST(o_custkey AS STRING)" + (" || '-' || year(o_orderdate)" if account else "")
    orders = table(spark, d, "orders").selectExpr("o_orderkey AS l_orderkey", f"{who} AS mail")
    parts = table(spark, d, "part").selectExpr(
        "p_partkey AS l_partkey", "p_name AS titulo", "p_type AS descripcion", "p_brand AS MARCA",
        "if(p_size <= 35, 'FF', 'other') AS `CATEGORÍA`",
        "if(p_type IN ('PROMO', 'STANDARD'), 1, 2) AS tipo_prd_id", "p_size")
    items = table(spark, d, "lineitem")
    n = pieces(items)
    by_part = n if n and pieces(parts) else 0   # a small product table may be broadcast
    joined = dealt_join(dealt_join(items, orders, "l_orderkey", n), parts, "l_partkey", by_part)
    return joined.select(
        *[F.expr(e) for e in (
            "mail", "l_orderkey AS post_id", "l_orderkey AS bill_id", "l_partkey AS product_id",
            "titulo", "descripcion", "MARCA", "`CATEGORÍA`", "tipo_prd_id",
            "if(l_returnflag = 'R', 'pmi-credit-note', 'pmi-bill') AS type",
            "CAST(l_quantity AS INT) AS quantity", "l_shipdate AS fecha",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS total_actualizado")],
        period(F.col("l_shipdate")).alias("Periodo"), "l_linenumber", "l_suppkey", "p_size")


def _lines_sql(name: str, who: str) -> str:
    return f"""{name} AS (
  SELECT {who} AS mail, l_orderkey AS post_id, l_orderkey AS bill_id, l_partkey AS product_id,
    p_name AS titulo, p_type AS descripcion, p_brand AS "MARCA",
    CASE WHEN p_size <= 35 THEN 'FF' ELSE 'other' END AS "CATEGORÍA",
    CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN 1 ELSE 2 END AS tipo_prd_id,
    CASE WHEN l_returnflag = 'R' THEN 'pmi-credit-note' ELSE 'pmi-bill' END AS type,
    CAST(l_quantity AS INTEGER) AS quantity, l_shipdate AS fecha,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS total_actualizado,
    strftime(l_shipdate, '%Y-%m') AS "Periodo", l_linenumber, l_suppkey, p_size
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


LINES = _lines_sql("lines", "CAST(o_custkey AS VARCHAR)")
ACCOUNTS = _lines_sql("lines", "CAST(o_custkey AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR)")
TIE_SQL = "l_linenumber, product_id, l_suppkey, total_actualizado, quantity, bill_id"


def priced_attributes(lines: DataFrame) -> DataFrame:
    """Combo and presentation columns for the feature operators."""
    qty = F.col("quantity")
    return lines.withColumns({
        "Combo": F.when(((qty < 10) | (qty % 2 != 0)) & ~qty.isin(15, 45, 1), 1).otherwise(0),
        "Presentacion": F.when(F.col("tipo_prd_id") == 2, "Otros Productos")
        .when(F.col("p_size") % 2 == 0, "Box").otherwise("Soft_pack")})


ATTRIBUTED = """attributed AS (
  SELECT *, CASE WHEN (quantity < 10 OR quantity % 2 <> 0) AND quantity NOT IN (15, 45, 1)
      THEN 1 ELSE 0 END AS "Combo",
    CASE WHEN tipo_prd_id = 2 THEN 'Otros Productos' WHEN p_size % 2 = 0 THEN 'Box'
      ELSE 'Soft_pack' END AS "Presentacion"
  FROM lines)"""


# --- price log -----------------------------------------------------------------------------

def unit_cents() -> Column:
    """Price of one unit, whole cents."""
    cents = F.floor(F.col("l_extendedprice") * 100 / F.col("l_quantity")).cast("decimal(16,0)")
    return (cents * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(18,2)")


UNIT_CENTS = ("CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) * CAST(0.01 AS DECIMAL(3,2)) "
              "AS DECIMAL(18,2))")


def price_log(spark: SparkSession, d: str) -> DataFrame:
    """Unit prices over time: each line is an entry, and a large quantity stands for a price
    that was never filled in."""
    return table(spark, d, "lineitem").select(
        F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias("fecha"),
        F.when(F.col("l_quantity") < 49, unit_cents()).alias("precio"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")


PRICE_TIE = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
PRICE_LOG = f"""price_log AS (
  SELECT l_partkey AS product_id, l_shipdate AS fecha,
    CASE WHEN l_quantity < 49 THEN {UNIT_CENTS} END AS precio,
    l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  FROM lineitem)"""
LATEST = """latest AS (
  SELECT product_id, precio FROM (
    SELECT product_id, precio, row_number() OVER (PARTITION BY product_id
      ORDER BY fecha DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC,
        l_extendedprice DESC) AS rn FROM price_log)
  WHERE rn = 1 AND precio IS NOT NULL)"""


# --- snapshots -----------------------------------------------------------------------------

def states(spark: SparkSession, d: str) -> DataFrame:
    """Every event as a dated state of its user."""
    return table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("mail"), F.col("ts").alias("fecha_segmentacion"),
        F.col("event_type").alias("rfm"), "event_id")


STATES = """states AS (
  SELECT CAST(user_id AS VARCHAR) AS mail, ts AS fecha_segmentacion, event_type AS rfm, event_id
  FROM events)"""


def weekly_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """One snapshot per user and week: label of the latest event, last purchase = latest time."""
    weekly = table(spark, d, "events").groupBy(
        F.col("user_id").cast("string").alias("mail"),
        F.date_trunc("week", "ts").cast("date").alias("fecha_segmentacion"))
    return weekly.agg(
        F.max_by("event_type", F.struct("ts", "event_id")).alias("rfm"),
        F.max("ts").alias("ultima_compra"))


SNAPSHOTS = """snaps AS (
  SELECT CAST(user_id AS VARCHAR) AS mail, CAST(date_trunc('week', ts) AS DATE) AS fecha_segmentacion,
    arg_max(event_type, (ts, event_id)) AS rfm, max(ts) AS ultima_compra
  FROM events GROUP BY 1, 2)"""


# --- customers -----------------------------------------------------------------------------

RFM = """rfm AS (
  SELECT mail, CAST(sum(total_actualizado) AS DOUBLE) AS "ValorMonetario",
    count(fecha) AS "Frecuencia",
    CAST(date_sub('day', max(fecha), (SELECT max(fecha) FROM lines)) AS INTEGER) AS "Recencia"
  FROM lines WHERE mail IS NOT NULL GROUP BY mail)"""


# --- shop tables ---------------------------------------------------------------------------

def shop(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The shop's normalised tables. A bill is an (order, day, sale-or-note) of the lines. Order
    and product ids are told apart by an offset, since both are posts with attributes."""
    orders, items, parts = (table(spark, d, t) for t in ("orders", "lineitem", "part"))
    note = (F.col("l_returnflag") == "R").cast("int")
    bill = (F.col("l_orderkey") * 10000 + F.datediff("l_shipdate", F.lit("1994-01-01")) * 2
            + note).alias("bill_id")
    product = (F.col("p_partkey") + 1_000_000_000).alias("post_id")
    kind = F.when(F.col("p_type").isin("PROMO", "STANDARD"), "1").otherwise("2")
    return {
        "orders": orders.select(F.col("o_orderkey").alias("ID"),
                                F.when(F.col("o_orderpriority") == "5-LOW", "shop_quote")
                                .otherwise("shop_order").alias("post_type"),
                                F.when(F.col("o_orderstatus") == "P", "wc-pending")
                                .otherwise("wc-bill").alias("post_status"),
                                F.col("o_orderdate").alias("post_date")),
        "products": parts.select(
            (F.col("p_partkey") + 1_000_000_000).alias("product_id"), F.col("p_name").alias("titulo"),
            F.concat("p_type", F.when(F.col("p_size") % 4 == 0, " Box ").otherwise(" "),
                     F.col("p_size").cast("string")).alias("descripcion")),
        "attributes": orders.select(
            F.col("o_orderkey").alias("post_id"), F.lit("_billing_email").alias("meta_key"),
            F.col("o_custkey").cast("string").alias("meta_value"),
        ).unionByName(parts.select(product, F.lit("tipo_prd_id").alias("meta_key"),
                                   kind.alias("meta_value"))),
        "bills": items.select(
            F.col("l_orderkey").alias("post_id"), bill,
            F.when(note == 1, "pmi-credit-note").otherwise("pmi-bill").alias("type"),
            F.col("l_shipdate").alias("fecha")).distinct(),
        "items": items.select(bill, (F.col("l_partkey") + 1_000_000_000).alias("product_id"),
                              F.col("l_quantity").cast("int").alias("quantity")),
        "prices": items.select(
            (F.col("l_partkey") + 1_000_000_000).alias("product_id"), F.col("l_shipdate").alias("fecha"),
            unit_cents().alias("precio")),
    }


_BILL = ("l_orderkey * 10000 + date_diff('day', DATE '1994-01-01', CAST(l_shipdate AS DATE)) * 2 "
         "+ CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END")
SHOP = f"""s_orders AS (
  SELECT o_orderkey AS "ID", CASE WHEN o_orderpriority = '5-LOW' THEN 'shop_quote' ELSE 'shop_order' END AS post_type,
    CASE WHEN o_orderstatus = 'P' THEN 'wc-pending' ELSE 'wc-bill' END AS post_status,
    o_orderdate AS post_date FROM orders),
s_products AS (
  SELECT p_partkey + 1000000000 AS product_id, p_name AS titulo,
    p_type || CASE WHEN p_size % 4 = 0 THEN ' Box ' ELSE ' ' END || CAST(p_size AS VARCHAR) AS descripcion
  FROM part),
s_attributes AS (
  SELECT o_orderkey AS post_id, '_billing_email' AS meta_key, CAST(o_custkey AS VARCHAR) AS meta_value
  FROM orders
  UNION ALL
  SELECT p_partkey + 1000000000, 'tipo_prd_id',
    CASE WHEN p_type IN ('PROMO', 'STANDARD') THEN '1' ELSE '2' END FROM part),
s_bills AS (
  SELECT DISTINCT l_orderkey AS post_id, {_BILL} AS bill_id,
    CASE WHEN l_returnflag = 'R' THEN 'pmi-credit-note' ELSE 'pmi-bill' END AS type,
    l_shipdate AS fecha FROM lineitem),
s_items AS (
  SELECT {_BILL} AS bill_id, l_partkey + 1000000000 AS product_id,
    CAST(l_quantity AS INTEGER) AS quantity FROM lineitem),
s_prices AS (
  SELECT l_partkey + 1000000000 AS product_id, l_shipdate AS fecha,
    {UNIT_CENTS} AS precio FROM lineitem)"""


def catalog(spark: SparkSession, d: str) -> DataFrame:
    """Title, brand and category of the whole product table."""
    return table(spark, d, "part").select(
        F.col("p_name").alias("titulo"), F.col("p_brand").alias("MARCA"),
        F.when(F.col("p_size") <= 35, "FF").otherwise("other").alias("CATEGORÍA"))


CATALOG = """catalog AS (
  SELECT titulo, "MARCA", "CATEGORÍA" FROM (
    SELECT *, row_number() OVER (PARTITION BY titulo ORDER BY "MARCA", "CATEGORÍA") AS rn FROM (
      SELECT p_name AS titulo, p_brand AS "MARCA",
        CASE WHEN p_size <= 35 THEN 'FF' ELSE 'other' END AS "CATEGORÍA"
      FROM part)) WHERE rn = 1)"""
