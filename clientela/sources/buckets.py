"""Tables bucketed and sorted by a key, so that joins and aggregations on it need no shuffle.

A bucket is read by one task, so a key that holds a large share of all rows must not lie in one. Rows
of such keys, and rows without a key, are stored apart, spread evenly. No key is in both parts:
what is computed per key is computed on each part and put together."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.sources.staging import broadcast_if_bounded

HOT_ROWS = 1_000_000
BUCKET_ROWS = 500_000   # of a bucket, which one task sorts
MOST_BUCKETS = 4_096    # files of a table that is written by bucket


class Buckets(NamedTuple):
    """The two parts of a stored table."""
    even: DataFrame     # bucketed and sorted by the key
    spread: DataFrame   # keys over HOT_ROWS rows, and null


def key_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, _n): rows of each key. Stored, it gives the hot keys and the number of buckets from one pass."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key): keys that more than `hot_rows` rows hold, of a table or its `key_rows`."""
    counts = df if "_n" in df.columns else key_rows(df, key)
    return counts.where((F.col("_n") > hot_rows) & F.col(key).isNotNull()).select(F.col(key).alias("_hot"))


def bucket_number(counts: DataFrame, least: int = 1) -> int:
    """Buckets for the table of these `key_rows`: at least `least`, more as it grows."""
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    return min(max(least, -(-rows // BUCKET_ROWS)), MOST_BUCKETS)


def store_bucketed(df: DataFrame, name: str, folder: str, key: str, buckets: int, hot: DataFrame) -> Buckets:
    """Write tables `name` (bucketed) and `name`_spread (rows of `hot` keys and null keys) into a folder
    of their own, in place of former tables of that name. Tables that are joined share `hot` and the number of
    buckets, so that a key lies in the same part of each."""
    spark = df.sparkSession
    hot = broadcast_if_bounded(hot)
    same = F.col(key) == F.col("_hot")
    even = df.where(F.col(key).isNotNull()).join(hot, same, "left_anti")
    (even.repartition(buckets, key).write.mode("overwrite").option("path", f"{folder}/even").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spread = df.join(hot, same, "left_semi").unionByName(df.where(F.col(key).isNull()))
    spread.write.mode("overwrite").option("path", f"{folder}/spread").format("parquet").saveAsTable(f"{name}_spread")
    return Buckets(spark.table(name), spark.table(f"{name}_spread"))


def per_key(work: Callable[..., DataFrame], *tables: Buckets) -> DataFrame:
    """`work` on the parts of tables bucketed by the same key, put together. It must keep the rows of
    different keys apart, as a join or an aggregation on the key does."""
    return work(*[t.even for t in tables]).unionByName(work(*[t.spread for t in tables]))
