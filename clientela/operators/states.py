"""Moves and gaps of customers kept up snapshot by snapshot.

Instead of looking back over all snapshots, the latest state of each customer is carried along: a
new snapshot meets it once, which gives the moves, gaps and counts of that date. What a date
contributes is stored under the date, so a re-run of it replaces its own part: edge counts are sums
over dates."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.functions import scalars as S

DATE = "fecha_segmentacion"
STATE = ("mail", DATE, "rfm", "ultima_compra")


def start(snapshot: DataFrame) -> DataFrame:
    """An empty state table for snapshots like this one."""
    row = [F.col(c) for c in STATE]
    return snapshot.select(*row, F.struct(*row[1:]).alias("before")).where("false")


def withdraw(latest: DataFrame, date) -> DataFrame:
    """The state table before the run of `date`, its last one: customers of that date are again
    what they were, those it brought in are gone."""
    own = F.col(DATE) == F.lit(date).cast("date")
    back = {c: F.when(own, F.col(f"before.{c}")).otherwise(F.col(c)) for c in STATE[1:]}
    return (latest.where(~own | F.col("before").isNotNull()).withColumns({**back, "_own": own})
            .withColumn("before", F.when(~F.col("_own"), F.col("before"))).drop("_own"))


def advance(latest: DataFrame, snapshot: DataFrame, date) -> tuple[DataFrame, DataFrame]:
    """(moves, latest): the rows of the snapshot of `date` with what each customer was before, and
    the state table to carry on: a row per customer with its last state and the one before it.

    Snapshots come in the order of their dates, one row per customer, and purchases do not go back
    in time. A repeated run of the last date first takes back what the run before left. Rows without
    a customer have no predecessor and leave no state; a missing label or purchase is kept as such,
    as where all snapshots are looked at together."""
    earlier = withdraw(latest, date)
    was = earlier.select("mail", F.struct(*STATE[1:]).alias("_was"))
    met = snapshot.join(was, "mail", "left").withColumns(
        {"rfm_anterior": F.col("_was.rfm"), "compra_anterior": F.col("_was.ultima_compra")})
    now = met.where(F.col("mail").isNotNull()).select(*STATE, F.col("_was").alias("before"))
    kept = earlier.join(snapshot.select("mail"), "mail", "left_anti")
    return _gaps(met, snapshot), kept.select(*now.columns).unionByName(now)


def _gaps(moves: DataFrame, snapshot: DataFrame) -> DataFrame:
    days = S.elapsed_days(F.col("compra_anterior"), F.col("ultima_compra")).cast("int")
    return (moves.withColumn("gap_entre_compras", days).withColumn("segmento_gap", S.gap_bucket(F.col("gap_entre_compras")))
            .select(*snapshot.columns, "rfm_anterior", "gap_entre_compras", "segmento_gap"))


def edge_part(moves: DataFrame) -> DataFrame:
    """(date, previous, current, count): what a snapshot's moves add to the edges."""
    return (moves.select(DATE, "rfm_anterior", "rfm").na.drop().groupBy(DATE, "rfm_anterior", "rfm")
            .agg(F.count(F.lit(1)).alias("cantidad")))


def edges(parts: DataFrame) -> DataFrame:
    """Edges over all dates; `transitions.transition_matrix` takes them as they are."""
    return parts.groupBy("rfm_anterior", "rfm").agg(F.sum("cantidad").alias("cantidad"))


def without_date(parts: DataFrame, date) -> DataFrame:
    """Parts of all dates but one, whose run is repeated."""
    return parts.where(F.col(DATE) != F.lit(date).cast("date"))
