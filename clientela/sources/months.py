"""Tables stored in one folder per month, of which a run reads the months it needs.

Which months those are may come out of the data, as the months of `current` do. They are a small
frame then, joined to the table; Spark finds them first and leaves the other folders unread."""

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.sources.files import write_snapshot
from clientela.sources.staging import staged

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def store_by_month(df: DataFrame, folder: str, col: str = "Periodo") -> None:
    """Write rows in place of what the folder holds for their months; other months are not touched,
    nor read. A null month is a month."""
    write_snapshot(df, folder, "parquet", partition=col)


def stored_table(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder)


def months_held(spark: SparkSession, folder: str, col: str = "Periodo", kind: str = "string") -> DataFrame:
    """(col): the months of a stored table, read off its folder names; one row per month, without data
    being opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    found = sorted(n.removeprefix(f"{col}=") for n in names if n.startswith(f"{col}="))
    rows = [(None if n == NULL_FOLDER else unquote(n),) for n in found]
    return spark.createDataFrame(rows, f"`{col}` string").select(F.col(f"`{col}`").cast(kind).alias(col))


def of_months(table: DataFrame, months: DataFrame, col: str = "Periodo") -> DataFrame:
    """Rows of a stored table whose month is among `months` (col), null included. `months` holds at most
    one row per month, so it is broadcast; the folders of other months are not read."""
    held = staged(months.select(F.col(col).alias("_month")).distinct().withColumn("_null", F.col("_month").isNull().cast("int")), "month-list")
    # Spark prunes folders by a frame that a comparison has filtered.
    known = table.join(F.broadcast(held.where("_null = 0")), F.col(col) == F.col("_month"), "left_semi")
    null = held.where("_null = 1").select("_null")  # one row or none
    return known.unionByName(table.where(F.col(col).isNull()).join(F.broadcast(null), F.lit(True), "left_semi"))


def latest_month(spark: SparkSession, folder: str, col: str = "Periodo", kind: str = "string") -> DataFrame:
    """(col): the greatest month that a stored table holds."""
    return months_held(spark, folder, col, kind).agg(F.max(col).alias(col))


def upsert_months(table: DataFrame, folder: str, current: DataFrame, col: str = "Periodo") -> DataFrame:
    """`upsert_period` on the table stored in `folder`: its rows of months that `current` has none of, and
    `current`. Only those months are read; which they are follows from the folder names and `current`."""
    kind = table.schema[col].dataType.simpleString()
    new = current.select(F.col(col).cast(kind).alias("_new")).distinct()
    held = months_held(table.sparkSession, folder, col, kind)
    others = held.join(new, F.col(col).eqNullSafe(F.col("_new")), "left_anti")
    return of_months(table, others, col).unionByName(current, allowMissingColumns=True)
