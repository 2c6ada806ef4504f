"""What recurs across documents: units with a digest, first holders, and runs of repeated units."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def repeated(units: DataFrame) -> DataFrame:
    """Units (id, h1, h2, again, ...) that occurred before, with `source`, the least id that holds
    the same digest. `again` marks a unit seen earlier in its own text; the others count once per
    text, so one long text cannot make a digest hot, and digests merge before the shuffle."""
    first = units.where("NOT again")
    shared = (first.groupBy("h1", "h2").agg(F.min("id").alias("source"), F.max("id").alias("last"))
              .where("source < last").drop("last"))
    across = first.join(shared, ["h1", "h2"]).where("source < id")
    within = units.where("again").withColumn("source", F.col("id"))
    return across.unionByName(within)


def runs(found: DataFrame, sums: tuple[str, ...] = (), more: tuple[Column, ...] = ()) -> DataFrame:
    """Merge repeated units (id, start, end, source, ...) of a text that touch or overlap into
    longest runs: id, start, end, source (of the first unit), units, the named sums
    and more aggregates."""
    order = Window.partitionBy("id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)
    numbered = found.withColumn("reach", reach).withColumn("run", F.sum(opened).over(order))
    return numbered.groupBy("id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        F.min_by("source", F.struct("start", -F.col("end"), "source")).alias("source"), F.count("*").alias("units"),
        *[F.sum(c).alias(c) for c in sums], *more).drop("run")
