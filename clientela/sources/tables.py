"""Shop tables from Parquet or a JDBC database. Connection options come from the caller."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela import contracts as C


def read_table(spark: SparkSession, source: str | dict, split: tuple | None = None) -> DataFrame:
    """A Parquet path, or JDBC options. `split` = (column, low, high, parts) reads the table in
    parallel ranges; filters on the result are pushed into the database's WHERE clause."""
    if isinstance(source, str):
        return spark.read.parquet(source)
    reader = spark.read.format("jdbc").option("preferTimestampNTZ", "true").options(**source)
    if split is not None:
        column, low, high, parts = split
        reader = (reader.option("partitionColumn", column).option("lowerBound", str(low))
                  .option("upperBound", str(high)).option("numPartitions", str(parts)))
    return reader.load()


def shop_sources(options: dict, names: dict[str, str] = C.SHOP_TABLES) -> dict[str, dict]:
    """JDBC options per role, from the connection options all share."""
    return {role: {**options, "dbtable": name} for role, name in names.items()}


def shop_tables(posts: DataFrame, attributes: DataFrame, bills: DataFrame, items: DataFrame,
                prices: DataFrame) -> dict[str, DataFrame]:
    """The shop's tables in the columns the operators use. Posts hold orders and products."""
    return {
        "orders": posts.select("ID", "post_type", "post_status", "post_date"),
        "products": posts.select(F.col("ID").alias("product_id"),
                                 F.col("post_title").alias("titulo"),
                                 F.col("post_content").alias("descripcion")),
        "attributes": attributes.select("post_id", "meta_key", "meta_value"),
        "bills": bills.select(F.col("order_id").alias("post_id"), F.col("id").alias("bill_id"),
                              "type", F.col("creation_date").alias("fecha")),
        "items": items.select("bill_id", "product_id", F.col("quantity").cast("int").alias("quantity")),
        "prices": prices.select("product_id", F.col("creation_date").alias("fecha"),
                                F.col("neto").cast("decimal(18,2)").alias("precio")),
    }
