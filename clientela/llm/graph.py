"""Connected components of an edge table by repeated contraction. Nothing is collected."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.llm.store import empty, keep


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b); component is the smallest node that
    can be reached. Each round, a node joins its neighbour of least rank, ranks being a hash that
    changes by round, so long chains shrink by a constant factor too. A hot node costs nothing
    special: its neighbours are merged before the shuffle."""
    edges = keep(edges.where("a <> b").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = nodes.select("node", F.col("node").alias("root"))
    turn = 0
    while not empty(edges):
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("to"))
        both = edges.union(edges.select("b", "a"))
        parents = (both.groupBy("a").agg(F.min(rank("b")).alias("best"))
                   .where(F.col("best") < rank("a"))
                   .select(F.col("a").alias("root"), F.col("best.to").alias("parent")))
        parents = keep(parents, "parents")
        moved = edges
        for end in ("a", "b"):
            moved = (moved.join(parents.withColumnRenamed("root", end), end, "left")
                     .withColumn(end, F.coalesce("parent", end)).drop("parent"))
        edges = keep(moved.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .where("a <> b").distinct(), "edges")
        labels = keep(labels.join(parents, "root", "left")
                      .select("node", F.coalesce("parent", "root").alias("root")), "labels")
        turn += 1
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least, "root").select("node", "component")
