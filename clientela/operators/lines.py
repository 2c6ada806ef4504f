"""From shop tables to net, formatted, priced sale lines."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.functions import scalars as S
from clientela.sources.staging import broadcast_if_bounded, staged
from clientela.operators.ordered import HOT_ROWS, neighbour
from clientela.operators.relational import (
    drop_returns, fetch_by_keys, fill_defaults, first_per_key, lookup_join, require)

MONTH_ORDERS = 1_000_000   # whose ids may be broadcast


def month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    year, number = map(int, month.split("-"))
    nxt = (year + 1, 1) if number == 12 else (year, number + 1)
    return dt.datetime(year, number, 1), dt.datetime(*nxt, 1)


def in_month(col: Column, month: str) -> Column:
    """Half-open range on the raw column, which reaches the scan as a pushed filter."""
    start, nxt = month_bounds(month)
    return (col >= F.lit(start).cast("timestamp_ntz")) & (col < F.lit(nxt).cast("timestamp_ntz"))


def orders_in_month(orders: DataFrame, month: str, kind: str = C.ORDER_TYPE,
                    status: str = C.ORDER_STATUS, ordered: bool = False) -> DataFrame:
    """Orders of one type and status placed in a month; newest first if `ordered`."""
    rows = orders.filter((F.col("post_type") == kind) & (F.col("post_status") == status)
                         & in_month(F.col("post_date"), month))
    return rows.orderBy(F.col("post_date").desc(), "ID") if ordered else rows


def eav_attribute(meta: DataFrame, key: str, out: str) -> DataFrame:
    """One attribute of every entity, one row per stored value."""
    return meta.filter(F.col("meta_key") == key).select("post_id", F.col("meta_value").alias(out))


def eav_pivot(meta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several attributes side by side; of repeated values the greatest is taken."""
    return (meta.filter(F.col("meta_key").isin(*keys)).groupBy("post_id")
            .pivot("meta_key", list(keys)).agg(F.max("meta_value")))


def assemble_lines(orders: DataFrame, emails: DataFrame, bills: DataFrame, items: DataFrame,
                   products: DataFrame, kinds: DataFrame, keep_unmailed: bool = True) -> DataFrame:
    """Order ids -> e-mail -> bills -> items -> product text and kind.

    Items drive: every item of a bill of these orders gives a line. An order with several
    e-mails keeps the smallest, so lines do not fan out. `keep_unmailed=False` drops orders
    without an e-mail. Every large table is cut down to the given orders before anything else
    is joined to it; where the orders are few, those cuts are broadcast joins."""
    ids = orders.select(F.col("ID").alias("post_id")).distinct()
    mails = fetch_by_keys(emails, ids, "post_id").groupBy("post_id").agg(F.min("mail").alias("mail"))
    billed = fetch_by_keys(bills, ids, "post_id").join(mails, "post_id", "left" if keep_unmailed else "inner")
    sold = items.join(billed, "bill_id")
    one_kind = kinds.groupBy("product_id").agg(F.max("tipo_prd_id").alias("tipo_prd_id"))
    described = sold.join(products, "product_id", "left").join(one_kind, "product_id", "left")
    return described.select(
        "bill_id", "product_id", "quantity", "titulo", "descripcion",
        S.coerce_int(F.col("tipo_prd_id"), 0).cast("int").alias("tipo_prd_id"),
        "post_id", "type", "fecha", "mail")


def net_credit_notes(lines: DataFrame, text: str = "titulo_descripcion",
                     product: str = "product_id", order: str = "post_id",
                     tie: Sequence[str] = ("bill_id", "quantity"),
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """Subtract a credit note from the row it follows.

    Rows are ordered by (order, text, date). A note directly after a row of the same order and
    product, and strictly later, takes its original quantity off that row. Each row is changed
    at most once, by the row after it, so one look ahead is enough. Lines without an order are
    never netted.

    A product has one text, so rows of one product are neighbours only within (order, text):
    this is the group. One of more than `hot_rows` lines is cut further."""
    keyed = (lines.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
             .withColumn("_none", F.col(text).isNull()))
    ahead = neighbour(keyed, [order, "_none", "_text"], ["fecha", *tie],
                      [product, "type", "fecha", "quantity"], "_next", forward=True, hot_rows=hot_rows)
    nxt = F.col("_next")
    hit = ((nxt["type"] == C.CREDIT_NOTE) & (nxt[product] == F.col(product))
           & (nxt["fecha"] > F.col("fecha")))
    net = F.when(hit, F.col("quantity") - nxt["quantity"]).otherwise(F.col("quantity"))
    return ahead.withColumn("quantity", net).select(*lines.columns)


def format_lines(lines: DataFrame, v1: bool = False, special: str | None = None) -> DataFrame:
    """Derived attributes of a line: pack, presentation, combo, month, carton."""
    text, kind, qty = F.col("titulo_descripcion"), F.col("tipo_prd_id"), F.col("quantity")
    return lines.select(
        "*",
        S.pack_units(text, kind, None if v1 else 1).alias("Unidad"),
        S.presentation(text, kind, None if v1 else "Soft_pack").alias("Presentacion"),
        S.combo_flag(qty, exclude_one=not v1).alias("Combo"),
        S.period(F.col("fecha")).alias("Periodo"),
        S.carton_size(kind, text, special, exact=v1).alias("Carton_unidad"),
    ).withColumn("Carton_cantidad", S.carton_count(qty, F.col("Carton_unidad")))


def enrich_catalog(lines: DataFrame, catalog: DataFrame, default_category: bool = True) -> DataFrame:
    """Brand and category by cleaned title; unknown titles get the default brand.
    The catalogue is one row per title (the smallest brand wins), so lines never fan out."""
    table = first_per_key(catalog.select("titulo", "MARCA", "CATEGORÍA"), ["titulo"],
                          ["MARCA", "CATEGORÍA"])
    cleaned = lines.withColumn("titulo", S.clean_title(F.col("titulo")))
    defaults = {"MARCA": C.DEFAULT_BRAND}
    if default_category:
        defaults["CATEGORÍA"] = C.DEFAULT_BRAND
    return fill_defaults(lookup_join(cleaned, broadcast_if_bounded(table), "titulo"), defaults)


def attach_latest_price(lines: DataFrame, prices: DataFrame, default: float | None = 0) -> DataFrame:
    """Current price per product and the value of the line at that price. A product without a
    price is worth `default` (None leaves the value null)."""
    priced = lines.join(prices.select("product_id", "precio"), "product_id", "left")
    if default is not None:
        filler = F.lit(default).cast(prices.schema["precio"].dataType)
        priced = priced.withColumn("precio", F.coalesce("precio", filler))
    return priced.withColumn("total_actualizado", S.line_value(F.col("precio"), F.col("quantity")))


def month_lines(tables: dict[str, DataFrame], month: str, kind: str = C.ORDER_TYPE,
                status: str = C.ORDER_STATUS, v1: bool = False,
                special: str | None = None) -> DataFrame:
    """Unpriced net lines of one month from the shop tables: orders, attributes, bills, items,
    products."""
    orders = broadcast_if_bounded(orders_in_month(tables["orders"], month, kind, status), MONTH_ORDERS)  # bills of others are not shuffled
    meta = tables["attributes"]
    raw = assemble_lines(
        orders, eav_attribute(meta, C.EMAIL_KEY, "mail"), tables["bills"], tables["items"],
        tables["products"],
        eav_attribute(meta, C.KIND_KEY, "tipo_prd_id").withColumnRenamed("post_id", "product_id"),
        keep_unmailed=not v1)
    texted = staged(require(raw, ["fecha"]).withColumn(
        "titulo_descripcion", S.full_text(F.col("titulo"), F.col("descripcion"), not v1)), "month-lines")  # netting reads it twice
    net = drop_returns(net_credit_notes(texted), positive_only=not v1)
    return format_lines(net, v1, special)
