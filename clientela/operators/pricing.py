"""Latest prices, the basket index, and history at current prices."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.functions import scalars as S
from clientela.operators.ordered import first_per_key, order_key
from clientela.operators.relational import broadcast_scalar


def latest_price(log: DataFrame, tie: Sequence[str] = ("precio",),
                 drop_null: bool = True) -> DataFrame:
    """Last price of each product. A product whose last entry has no price is left out, it does
    not fall back to an older one."""
    last = (log.filter(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(F.max_by("precio", order_key(["fecha", *tie])).alias("precio")))
    return last.filter(F.col("precio").isNotNull()) if drop_null else last


def units_by_product(lines: DataFrame) -> DataFrame:
    return (lines.filter(F.col("product_id").isNotNull()).groupBy("product_id")
            .agg(F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity")))


def top_k_products(lines: DataFrame, k: int = 4) -> DataFrame:
    """Best sellers by units; equal units rank by product id."""
    return units_by_product(lines).orderBy(F.col("quantity").desc(), "product_id").limit(k)


def basket_index(lines: DataFrame, prices: DataFrame, history: DataFrame, k: int = 4,
                 tie: Sequence[str] = ("bill_id", "quantity", "total_actualizado"),
                 matched: bool = False) -> DataFrame:
    """One row `indice`: current price of the k best sellers over their first historical unit
    price. A best seller without history counts above the line only, unless `matched`.
    1.0 when the old basket has no value. The broadcast sets hold k rows."""
    top = F.broadcast(top_k_products(lines, k).select("product_id"))
    old = history.join(top, "product_id", "left_semi").select(
        "product_id", "fecha", *[c for c in tie if c != "fecha"])
    first = first_per_key(old, ["product_id"], ["fecha", *tie]).select(
        "product_id",
        S.unit_price(F.col("total_actualizado"), F.col("quantity")).alias("viejo"))
    new = prices.join(top, "product_id", "left_semi").select(
        "product_id", F.col("precio").cast("double").alias("nuevo"))
    basket = new.join(first, "product_id", "left" if matched is False else "inner")
    # An old price counts even where the product has no current price.
    old_sum = (first if not matched else basket).agg(F.sum("viejo").alias("vieja"))
    sums = basket.agg(F.sum("nuevo").alias("nueva")).crossJoin(F.broadcast(old_sum))
    value = F.when(F.col("vieja") > 0, F.coalesce("nueva", F.lit(0.0)) / F.col("vieja"))
    return sums.select(F.coalesce("nueva", F.lit(0.0)).alias("canasta_nueva"),
                       F.coalesce("vieja", F.lit(0.0)).alias("canasta_vieja"),
                       value.otherwise(F.lit(1.0)).alias("indice"))


def reprice_history(history: DataFrame, prices: DataFrame, index: DataFrame) -> DataFrame:
    """History at current money: the latest price where there is one, else the old unit price
    times the index. A price stored by an earlier run is dropped first."""
    base = history.drop("precio").join(
        prices.select("product_id", F.col("precio").cast("double").alias("_ahora")),
        "product_id", "left")
    old = S.unit_price(F.col("total_actualizado"), F.col("quantity"))
    priced = broadcast_scalar(base, index.select("indice")).withColumn(
        "precio", F.coalesce("_ahora", old * F.col("indice")))
    qty = F.coalesce("quantity", F.lit(0))
    return (priced.withColumn("total_actualizado",
                              S.line_value(F.coalesce("precio", F.lit(0.0)), qty))
            .drop("_ahora", "indice"))
