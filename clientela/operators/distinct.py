"""Distinct customers that add up over months: bitmaps over dense customer numbers.

A customer gets a number once, when first seen. A month keeps, per group, one bitmap for each 32,768
numbers; months are united by OR, so distinct counts over any months need only their bitmaps and
rows never multiply as they do under several distinct counts at once."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientela.sources.staging import staged


def enroll(registry: DataFrame | None, rows: DataFrame, key: str = "mail") -> DataFrame:
    """(key, n): the numbers given so far, from 1 without gaps, and the next ones for customers who
    have none. New customers are numbered where they lie, by their place in the partition and the
    sizes of those before; only these sizes, one row per partition, come together."""
    fresh = rows.select(key).where(F.col(key).isNotNull()).distinct()
    given = 0
    if registry is not None:
        fresh = fresh.join(registry, key, "left_anti")
        given = registry.agg(F.max("n")).first()[0] or 0
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # its lower bits count the rows of a partition
    laid = staged(fresh.select(key, F.spark_partition_id().alias("_part"), place.alias("_at")), "fresh")
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = staged(laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
                    .select("_part", F.coalesce(before, F.lit(0)).alias("_start")), "starts")  # a row per partition
    new = laid.join(F.broadcast(starts), "_part").select(key, (F.lit(given + 1) + F.col("_start") + F.col("_at")).alias("n"))
    return new if registry is None else registry.select(key, "n").unionByName(new)


def month_bitmaps(rows: DataFrame, registry: DataFrame, by: Sequence[str], key: str = "mail") -> DataFrame:
    """(by..., bucket, bits, filas): customers and rows of each group in one month. Rows without a
    customer count as rows, in a bucket of their own."""
    numbered = rows.select(*by, key).join(registry, key, "left")
    return numbered.groupBy(*by, F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"), F.count(F.lit(1)).alias("filas"))


def unite(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of several months, or of finer groups, as those of the groups `by`."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("filas").alias("filas"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Customers and rows per group over all the months given."""
    return unite(bitmaps, by).groupBy(*by).agg(
        F.sum(F.bitmap_count("bits")).alias("cantidad_de_clientes"), F.sum("filas").alias("filas"))
