"""Recency, frequency, monetary value; exact quantiles; outliers."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.functions import scalars as S
from clientela.operators.quantile import column_quantiles


def date_anchor(lines: DataFrame) -> DataFrame:
    """Latest date of all lines, one row."""
    return lines.agg(F.max("fecha").alias("max_fecha"))


def rfm(lines: DataFrame, anchor: DataFrame | None = None, rounded: bool = False,
        monetary: str = "ValorMonetario") -> DataFrame:
    """One aggregation per customer. Frequency counts dated lines; recency is the number of
    whole 24-hour periods from the last purchase to the latest date of all lines, which is read
    off the same aggregation: lines without a customer are one more group of it, then dropped."""
    total = F.coalesce(F.sum("total_actualizado").cast("double"), F.lit(0.0))
    groups = lines.groupBy("mail").agg(
        (S.round_money(total) if rounded else total).alias(monetary),
        F.count("fecha").alias("Frecuencia"), F.max("fecha").alias("_last"))
    # Both readers of the groups take all their columns and filter above them, so they share its shuffle.
    whole = F.max(F.struct("_last", monetary, "Frecuencia", "mail"))["_last"]
    one = groups.agg(whole.alias("max_fecha")) if anchor is None else anchor.select("max_fecha")
    known = F.when(F.col("mail").isNotNull(), F.col("_last")).isNotNull()
    dated = groups.filter(known).crossJoin(F.broadcast(one))
    return dated.select("mail", monetary, "Frecuencia",
                        S.elapsed_days(F.col("_last"), F.col("max_fecha")).alias("Recencia"))


def merge_rfm(monetary: DataFrame, frequency: DataFrame, recency: DataFrame) -> DataFrame:
    """Join of three per-customer tables made elsewhere; `rfm` needs no join."""
    return monetary.join(frequency, "mail").join(recency, "mail")


def iqr_bounds(df: DataFrame, cols: Sequence[str] = C.RFM_COLS, k: float = 1.5) -> DataFrame:
    """One row: lower and upper bound of every column."""
    quart = column_quantiles(df, cols, (0.25, 0.75))
    aggs = []
    for c in cols:
        q1, q3 = (f"max(valor) FILTER (WHERE columna = '{c}' AND p = {p}D)" for p in (0.25, 0.75))
        aggs += [F.expr(f"{q1} - {k!r}D * ({q3} - {q1})").alias(f"lo_{c}"),
                 F.expr(f"{q3} + {k!r}D * ({q3} - {q1})").alias(f"hi_{c}")]
    return quart.agg(*aggs)


def iqr_filter(df: DataFrame, cols: Sequence[str] = C.RFM_COLS, k: float = 1.5) -> DataFrame:
    """Rows with every column inside its bounds, bounds included. A null is never outside."""
    bounded = df.crossJoin(F.broadcast(iqr_bounds(df, cols, k)))
    inside = [f"coalesce(`{c}` BETWEEN `lo_{c}` AND `hi_{c}`, true)" for c in cols]
    return bounded.where(" AND ".join(inside)).select(*df.columns)
