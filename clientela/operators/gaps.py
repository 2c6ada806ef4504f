"""Days between purchases and their bands, per segment."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.functions import scalars as S
from clientela.operators.ordered import HOT_ROWS, neighbour
from clientela.operators.profile import describe

def purchase_gap(snap: DataFrame, within_label: bool = False,
                 tie: Sequence[str] = ("fecha_segmentacion",),
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """Whole days since the customer's previous `ultima_compra`, over all labels or within
    the same label, and its band. Rows without a customer (or label) have no previous one."""
    keys = ["mail", "rfm"] if within_label else ["mail"]
    prev = neighbour(snap, keys, ["ultima_compra", *tie], ["ultima_compra"], "_prev", hot_rows=hot_rows)
    days = S.elapsed_days(F.col("_prev.ultima_compra"), F.col("ultima_compra"))
    return (prev.withColumn("gap_entre_compras", days.cast("int"))
            .withColumn("segmento_gap", S.gap_bucket(F.col("gap_entre_compras")))
            .select(*snap.columns, "gap_entre_compras", "segmento_gap"))


def gap_distribution(gaps: DataFrame) -> DataFrame:
    """Customers and rows per segment and band."""
    return gaps.filter(F.col("rfm").isNotNull()).groupBy("rfm", "segmento_gap").agg(
        F.count_distinct("mail").alias("cantidad_de_clientes"),
        F.count(F.lit(1)).alias("filas"))


def gap_summary(gaps: DataFrame) -> DataFrame:
    """`describe` of the gap per segment."""
    return describe(gaps, ["gap_entre_compras"], by="rfm").drop("columna")
