"""The monthly jobs, each a composition of operators."""

import dataclasses
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.functions import scalars as S
from clientela.operators import cluster, features, gaps, ledger, lines, pricing, relational, snapshot
from clientela.operators import transitions
from clientela.operators.rfm import iqr_filter
from clientela.sources import files
from clientela.sources.staging import broadcast_if_bounded, owned, staged

PRICE_ROWS = 1_000_000   # products whose prices may be broadcast, two numbers each


@dataclasses.dataclass(frozen=True)
class Rules:
    """Where the variants of the job differ. Defaults are the latest rules."""

    v1: bool = False                 # line rules of the first version
    special: str | None = None       # text of the product sold in larger cartons
    zero_is_multi: bool = False      # no main product counts as several brands
    distinct_contents: bool = True   # each title once per month
    text_style: str = "joined"
    iqr_k: float | None = 1.5        # None: outliers stay
    k: int = 3
    method: str = "kmeans"           # or "lloyd", the repeatable one
    max_iter: int = 300
    seed: int = 42
    n_init: int = 10
    naming: str = "v1"
    within_label: bool = False


def monthly_lines(tables: dict[str, DataFrame], catalog: DataFrame, month: str,
                  kind: str = C.ORDER_TYPE, status: str = C.ORDER_STATUS,
                  rules: Rules = Rules()) -> DataFrame:
    """Net, formatted, catalogued and priced sale lines of one month. The month's lines are
    stored, since they are read twice: for the products whose prices are needed, and for pricing."""
    formatted = lines.month_lines(tables, month, kind, status, rules.v1, rules.special)
    named = staged(lines.enrich_catalog(formatted, catalog, default_category=not rules.v1), "month")
    prices = broadcast_if_bounded(month_prices(tables["prices"], named), PRICE_ROWS)
    return lines.attach_latest_price(named, prices, None if rules.v1 else 0)


def month_prices(log: DataFrame, month: DataFrame) -> DataFrame:
    """Latest prices of the products sold in the month."""
    return pricing.latest_price(relational.fetch_by_keys(log, month, "product_id"))


def accumulate(history: DataFrame | None, current: DataFrame, prices: DataFrame,
               period: str | None = None, tie: Sequence[str] = C.LINE_TIE) -> DataFrame:
    """History at current money plus the month. Reads the previous month's version and gives a
    new one, so a repeated run starts from the same input and changes nothing. With prices few
    enough to broadcast, the history is not shuffled."""
    if history is None:
        return current
    prices = broadcast_if_bounded(prices, PRICE_ROWS)
    index = pricing.basket_index(current, prices, history, tie=tie)
    repriced = pricing.reprice_history(history, prices, index)
    return relational.upsert_period(repriced, current, period=period)


def segment_rfm(rfm: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Outliers removed, scaled, clustered, named. `rfm` should be stored: it is read by the
    bounds, the scaling and the clustering."""
    kept = rfm if rules.iqr_k is None else iqr_filter(rfm, k=rules.iqr_k)
    scaled = cluster.standardize(kept)
    if rules.method == "lloyd":
        grouped = cluster.kmeans_lloyd(scaled, k=rules.k, iters=rules.max_iter)
    else:
        grouped = cluster.kmeans(scaled, k=rules.k, max_iter=rules.max_iter, seed=rules.seed,
                                 n_init=rules.n_init)
    return cluster.label_clusters(grouped, rules.naming)


def active_profile(history: DataFrame, as_of, days: int = 365,
                   zero_is_multi: bool = False) -> DataFrame:
    """Profile of each customer active in the `days` before `as_of`.

    Activity is read off the aggregated last purchase, so the lines are not joined to a list of
    customers. Lines without a value do not enter the profile but do show activity: only such
    recent lines, normally none, are looked at apart."""
    limit = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    valued = relational.require(history, ["mail", "fecha", "total_actualizado"])
    everyone = features.customer_profile(valued, zero_is_multi)
    recent = F.col("ultima_compra") >= limit
    unvalued = history.filter(F.col("total_actualizado").isNull() & F.col("mail").isNotNull()
                              & (F.col("fecha") >= limit))
    seen = unvalued.select("mail").distinct().withColumn("_seen", F.lit(True))
    return everyone.join(seen, "mail", "left").filter(recent | F.col("_seen")).drop("_seen")


def accumulate_ledger(state: dict[str, DataFrame] | None, current: DataFrame, prices: DataFrame,
                      tie: Sequence[str] = C.LINE_TIE) -> dict[str, DataFrame]:
    """`accumulate` on the ledger: last month's state at current money plus the month's own. The
    work is that of the month and of the customers' products, however long the history is. Reads the
    previous month's version and gives a new one; both tables of it should be stored."""
    month = ledger.month_state(current, tie)
    if state is None:
        return month
    prices = broadcast_if_bounded(prices, PRICE_ROWS)
    index = staged(pricing.basket_index(current, prices, state["firsts"], tie=tie), "index")
    old = {"ledger": ledger.reprice_ledger(state["ledger"], prices, index),
           "firsts": pricing.reprice_history(state["firsts"], prices, index).select(*state["firsts"].columns)}
    return ledger.merge_states(old, month, tie)


def segment_customers(history: DataFrame, as_of, date, rules: Rules = Rules(),
                      carried: DataFrame | None = None) -> DataFrame:
    """Snapshot of the customers active in the year before `as_of`, dated `date`. With the ledger
    `carried` along, features and RFM come from it, and the history is read for texts only.

    The stored history is read three times, in few columns: for the profile, the month texts
    and the single-brand texts. The profile is stored, and clustering carries the customer's
    row along, so features, RFM and labels need no join."""
    if carried is None:
        active = active_profile(history, as_of, zero_is_multi=rules.zero_is_multi)
    else:
        limit = F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 365 DAYS")
        active = ledger.ledger_profile(carried, rules.zero_is_multi).where(F.col("ultima_compra") >= limit)
    profile = staged(active, "profile")
    labelled = segment_rfm(features.with_recency(profile), rules)
    valued = relational.require(history, ["mail", "fecha", "total_actualizado"])
    return snapshot.build_snapshot(labelled, valued, date, rules.distinct_contents,
                                   rules.text_style)


def segmentation_history(current: DataFrame, old: DataFrame | None,
                         rules: Rules = Rules()) -> DataFrame:
    """All snapshots with purchase gaps. Legacy labels are renamed; a snapshot of the same date
    is replaced."""
    if old is not None:
        old = relational.replace_values(
            old.drop("gap_entre_compras", "segmento_gap").withColumn(
                "fecha_segmentacion", S.snapshot_date(F.col("fecha_segmentacion"))),
            C.LEGACY_LABELS)
        combined = relational.upsert_period(old, current, "fecha_segmentacion")
    else:
        combined = current
    return gaps.purchase_gap(combined, rules.within_label)


def gap_report(history: DataFrame, date) -> tuple[DataFrame, DataFrame]:
    """Distribution and summary of the gaps of the current snapshot."""
    now = relational.current_snapshot(history, date)
    return gaps.gap_distribution(now), gaps.gap_summary(now)


def transition_report(history: DataFrame, tie: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Edges, nodes and row shares of the moves between segments."""
    edges = transitions.transition_edges(history, tie)
    return {"edges": edges, "nodes": transitions.transition_nodes(history),
            "matrix": transitions.transition_matrix(edges)}


def run_month(shop: dict[str, DataFrame], catalog: DataFrame, as_of: str, store: str,
              first: bool = False, rules: Rules = Rules()) -> dict[str, str]:
    """The monthly run started on the day `as_of`: extract, accumulate, segment, append, publish.
    Returns the places written.

    `snapshot` holds the month's segmentation, `snapshots` those of all months with their gaps. Published
    for readers is the current month's part of them, in the month's folder (`current`) and as the
    latest version (`latest`, a folder that `files.published` finds).

    The run takes the month of the day before. `store` is the folder of all months; unless it is
    the `first` run, the month before has its place there. Each step reads what earlier steps or
    the month before stored and writes to a place of its own month, so a run that is repeated
    gives the same result. What it stores on the way is deleted when it ends."""
    spark = catalog.sparkSession
    calendar = S.run_calendar(F.lit(as_of))
    day, month, previous = spark.range(1).select(
        *[calendar[c].cast("string") for c in ("process_date", "process_month", "previous_month")]).first()
    date = f"{month}-01"
    paths = {name: f"{store}/{month}/{name}" for name in ("lines", "history", "snapshot", "snapshots", "current")}
    paths |= {name: f"{store}/{name}" for name in ("latest", "segments")}
    before = (lambda name: None) if first else (lambda name: spark.read.parquet(f"{store}/{previous}/{name}"))

    with owned(spark):
        files.write_snapshot(monthly_lines(shop, catalog, month, rules=rules), paths["lines"], "parquet")
        current = spark.read.parquet(paths["lines"])
        history = accumulate(before("history"), current, month_prices(shop["prices"], current), month)
        files.write_snapshot(history, paths["history"], "parquet", partition="Periodo")
        done = segment_customers(spark.read.parquet(paths["history"]), day, date, rules)
        files.write_snapshot(done, paths["snapshot"], "parquet")
        snapshots = segmentation_history(spark.read.parquet(paths["snapshot"]), before("snapshots"), rules)
        files.write_snapshot(snapshots, paths["snapshots"], "parquet")
        now = relational.current_snapshot(spark.read.parquet(paths["snapshots"]), date)
        paths["latest"] = files.publish_latest(now, paths["current"], paths["latest"])
        files.write_by_segment(now, paths["segments"])
    return paths
