"""Filters, joins, set operations and column shaping that the monthly jobs share.

Joins carry no broadcast hint unless the hinted side is bounded by construction (one row, k
rows, calendar months): for the rest Catalyst's size statistics and adaptive execution choose,
and a skewed key is split by the adaptive skew join."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientela import contracts as C
from clientela.operators.ordered import first_per_key


# --- filters -------------------------------------------------------------------------------

def drop_returns(df: DataFrame, positive_only: bool = True) -> DataFrame:
    """After netting: no credit-note rows, no emptied rows. Rows of unknown type stay."""
    sale = ~F.col("type").eqNullSafe(C.CREDIT_NOTE)
    qty = F.col("quantity") > 0 if positive_only else F.col("quantity") != 0
    return df.filter(sale & qty)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


def active_customers(df: DataFrame, anchor, days: int = 365) -> DataFrame:
    """All rows of the customers whose last purchase is at most `days` before `anchor`.

    A customer is active exactly when any of their rows is recent enough, so the key set is a
    filtered scan, and no per-customer maximum is needed."""
    limit = F.lit(anchor).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    keys = df.filter(F.col("fecha") >= limit).select("mail")
    return require(df, ["fecha", "mail"]).join(keys.distinct(), "mail", "left_semi")


def split_by_kind(df: DataFrame, kind: int) -> DataFrame:
    return df.filter(F.col("tipo_prd_id") == kind)


def segment_subset(df: DataFrame, label, col: str = "rfm") -> DataFrame:
    return df.filter(F.col(col) == label)


def current_snapshot(df: DataFrame, date) -> DataFrame:
    return df.filter(F.col("fecha_segmentacion") == F.lit(date).cast("date"))


def customer_lookup(rfm: DataFrame, mail) -> DataFrame:
    """One row for any asked customer: the recency, or found=false."""
    hit = rfm.filter(F.col("mail") == mail).agg(F.min("Recencia").alias("Recencia"),
                                                F.count(F.lit(1)).alias("_n"))
    return hit.select(F.lit(mail).alias("mail"), "Recencia", (F.col("_n") > 0).alias("found"))


# --- joins ---------------------------------------------------------------------------------

def fetch_by_keys(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of `table` whose key occurs in `keys`."""
    return table.join(keys.select(on).distinct(), on, "left_semi")


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_anti")


def join_dedup_right(left: DataFrame, right: DataFrame, key: str,
                     order: Sequence[str]) -> DataFrame:
    """Left join against one right row per key (the first by `order`), so rows never fan out."""
    return left.join(first_per_key(right, [key], order), key, "left")


def lookup_join(df: DataFrame, table: DataFrame, on: str) -> DataFrame:
    return df.join(table, on, "left")


def broadcast_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the one row of a global aggregate. More than one row is an error."""
    row = F.struct(*[F.col(f"`{c}`") for c in one_row.columns])
    one = one_row.agg(F.max(row).alias("_row"), F.count(F.lit(1)).alias("_n")).select(F.when(
        F.col("_n") <= 1, F.col("_row")).otherwise(F.raise_error(F.lit("more than one row"))).alias("_row"))
    return df.crossJoin(F.broadcast(one)).select(*df.columns, "_row.*")


def membership_flag(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """Per key and condition: 1 if any of its rows meets the condition."""
    aggs = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in flags.items()]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def map_labels(df: DataFrame, col: str, mapping: DataFrame, out: str) -> DataFrame:
    """Label of a code by lookup in a (code, label) table; unmapped codes give null."""
    table = mapping.toDF("_code", out)
    return df.join(table, F.col(col) == F.col("_code"), "left").drop("_code")


# --- columns -------------------------------------------------------------------------------

def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    return df.na.fill(defaults)


def replace_values(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Replace whole values in every string column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.replace(mapping, subset=text)


def align_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of `schema`, in order and type; missing ones are null."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


# --- sets, sorts, limits -------------------------------------------------------------------

def append_history(history: DataFrame, current: DataFrame) -> DataFrame:
    return history.unionByName(current, allowMissingColumns=True)


def with_history(current: DataFrame | None, history: DataFrame | None) -> DataFrame:
    """Whatever exists of the two; having neither is an error."""
    if current is None and history is None:
        raise ValueError("neither history nor current data")
    if history is None:
        return current
    return history if current is None else append_history(history, current)


def upsert_period(history: DataFrame, current: DataFrame, col: str = "Periodo",
                  period: str | None = None) -> DataFrame:
    """Append `current` in place of what history holds for the same period, so a repeated run
    changes nothing; null counts as a period too. With the period given, the filter prunes
    partitions of the history; otherwise the periods of `current` are looked up."""
    if period is not None:
        kept = history.filter(~F.col(col).eqNullSafe(period))
    else:
        months = current.select(F.col(col).alias("_period")).distinct()
        kept = history.join(months, F.col(col).eqNullSafe(F.col("_period")), "left_anti")
    return append_history(kept, current)


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def last_purchase(lines: DataFrame) -> DataFrame:
    return (lines.filter(F.col("mail").isNotNull()).groupBy("mail")
            .agg(F.max("fecha").alias("ultima_compra")))


def sort_rows(df: DataFrame, *cols: str) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def preview(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First n rows of a stated order."""
    return sort_rows(df, *order).limit(n)


