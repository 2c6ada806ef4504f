"""Moves of customers between segments from one snapshot to the next."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientela.operators.ordered import HOT_ROWS, neighbour

MOST_LABELS = 1_000   # columns of a matrix


def previous_state(snap: DataFrame, tie: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `rfm_anterior`, the customer's label in the snapshot before. Rows without a customer
    are left out."""
    known = snap.filter(F.col("mail").isNotNull())
    prev = neighbour(known, ["mail"], ["fecha_segmentacion", *tie], ["rfm"], "_prev", hot_rows=hot_rows)
    return prev.select(*snap.columns, F.col("_prev.rfm").alias("rfm_anterior"))


def transition_edges(snap: DataFrame, tie: Sequence[str] = ()) -> DataFrame:
    """(previous, current, count); customers that stayed are counted too."""
    moves = previous_state(snap, tie).select("rfm_anterior", "rfm").na.drop()
    return moves.groupBy("rfm_anterior", "rfm").agg(F.count(F.lit(1)).alias("cantidad"))


def transition_nodes(snap: DataFrame) -> DataFrame:
    """Snapshot rows per label over all months."""
    return (snap.filter(F.col("rfm").isNotNull()).groupBy("rfm")
            .agg(F.count(F.lit(1)).alias("cantidad")))


def transition_matrix(edges: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """One row per previous label, one column per current label with the row share. Labels are
    those of the edges, in alphabetical order, besides the given ones, which come first."""
    found = [r[0] for r in edges.select("rfm").distinct().orderBy("rfm").limit(MOST_LABELS + 1).collect()]
    if len(found) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    columns = [*(labels or ()), *[x for x in found if x not in (labels or ())]]
    total = F.sum("cantidad").over(Window.partitionBy("rfm_anterior"))
    shares = edges.withColumn("share", F.col("cantidad") / total)
    return (shares.groupBy("rfm_anterior").pivot("rfm", columns).agg(F.max("share"))
            .na.fill(0.0, columns))
