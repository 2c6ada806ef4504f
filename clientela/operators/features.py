"""Consumption patterns per customer."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.functions import scalars as S

PUBLISHED = ["mail", "Multimarca", "mezcla_en_misma_compra", "consume_combo", "FF",
             "cluster_patrones_consumo"]


def _per_bill(lines: DataFrame, extra: dict) -> DataFrame:
    """First aggregation step: one row per (bill, customer). The numeric key comes first, which
    makes the sort of the sort-based aggregation cheap."""
    main = F.col("tipo_prd_id") == C.KIND_MAIN
    brand = F.when(main, F.col("MARCA"))
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    return lines.filter(F.col("mail").isNotNull()).groupBy("bill_id", "mail").agg(
        flag(F.col("tipo_prd_id") == C.KIND_OTHER).alias("otros"),
        flag(main).alias("main"),
        flag(main & F.col("MARCA").isNull()).alias("no_brand"),
        F.min(brand).alias("lo"), F.max(brand).alias("hi"),
        flag(F.col("Combo") == 1).alias("combo"),
        flag(main & (F.col("Presentacion") == "Box")).alias("box"),
        flag(main & (F.col("Presentacion") == "Soft_pack")).alias("soft"),
        flag(~F.col("CATEGORÍA").eqNullSafe(C.FULL_FLAVOUR)).alias("no_ff"),
        *[agg.alias(name) for name, agg in extra.items()])


def _per_customer(bills: DataFrame, zero_is_multi: bool, extra: dict) -> DataFrame:
    several = F.coalesce(F.min("lo") < F.max("hi"), F.lit(False))
    if zero_is_multi:
        # The older rule counts a missing brand as one more, and no brand at all as several.
        with_gap = (F.max("no_brand") == 1) & F.min("lo").isNotNull()
        several = several | with_gap | (F.max("main") == 0)
    mixed = F.coalesce(F.col("bill_id").isNotNull() & (F.col("lo") < F.col("hi")), F.lit(False))
    return bills.groupBy("mail").agg(
        F.max("otros").alias("otros_productos"),
        several.cast("int").alias("Multimarca"),
        F.max("combo").alias("consume_combo"),
        F.max("box").alias("box"),
        F.max("soft").alias("soft_pack"),
        F.max(mixed.cast("int")).alias("mezcla_en_misma_compra"),
        (1 - F.max("no_ff")).alias("FF"),
        *[agg.alias(name) for name, agg in extra.items()])


def customer_features(lines: DataFrame, zero_is_multi: bool = False) -> DataFrame:
    """All flags of a customer and the pattern label.

    Aggregated in two steps, bill then customer. Whether several brands occur is decided by
    the smallest and greatest brand, so no set of brands is kept, and both steps merge rows
    before the shuffle. A bill has one customer, so brands mixed in a bill show per
    (customer, bill)."""
    flags = _per_customer(_per_bill(lines, {}), zero_is_multi, {})
    return with_pattern(flags)


def with_pattern(flags: DataFrame) -> DataFrame:
    return flags.withColumn("cluster_patrones_consumo",
                            S.pattern_label(F.col("Multimarca"), F.col("FF")))


def customer_profile(lines: DataFrame, zero_is_multi: bool = False) -> DataFrame:
    """Features, value, frequency and last purchase of each customer, in one pass."""
    bills = _per_bill(lines, {
        "total": F.sum("total_actualizado"), "n": F.count("fecha"), "last": F.max("fecha")})
    return with_pattern(_per_customer(bills, zero_is_multi, {
        "ValorMonetario": F.coalesce(F.sum("total").cast("double"), F.lit(0.0)),
        "Frecuencia": F.sum("n"), "ultima_compra": F.max("last")}))


def with_recency(profile: DataFrame) -> DataFrame:
    """Whole days from each last purchase to the latest of all."""
    latest = F.broadcast(profile.agg(F.max("ultima_compra").alias("_max")))
    return profile.crossJoin(latest).withColumn(
        "Recencia", S.elapsed_days(F.col("ultima_compra"), F.col("_max"))).drop("_max")


def mixed_brand_bills(lines: DataFrame) -> DataFrame:
    """Bills whose main products show more than one brand."""
    main = lines.filter((F.col("tipo_prd_id") == C.KIND_MAIN) & F.col("bill_id").isNotNull())
    return (main.groupBy("bill_id").agg(F.count_distinct("MARCA").alias("marcas"))
            .filter(F.col("marcas") > 1))


def mixing_customers(lines: DataFrame) -> DataFrame:
    """Customers with a main-product line in a mixed bill."""
    main = lines.filter(F.col("tipo_prd_id") == C.KIND_MAIN).select("mail", "bill_id")
    return (main.distinct().join(mixed_brand_bills(lines).select("bill_id"), "bill_id", "left_semi")
            .select("mail").distinct())


def brand_count(lines: DataFrame) -> DataFrame:
    """Number of different main-product brands per customer."""
    brand = F.when(F.col("tipo_prd_id") == C.KIND_MAIN, F.col("MARCA"))
    return (lines.filter(F.col("mail").isNotNull()).groupBy("mail")
            .agg(F.count_distinct(brand).alias("marcas")))
