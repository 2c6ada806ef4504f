"""Exact quantiles over all months that read few rows of old months.

A month is read once, when it comes. Equal values are merged; a sketch (KLL) of the distinct ones gives
cuts that split them into SLICES slices of about equal size, and they are stored by month and by runs
of slices. Each slice keeps its exact count, least and greatest value.

Over any months, these counts alone tell between which values a rank must lie: at most the slices
that begin up to x, and at least those that end up to x, hold values up to x. So the bracket is
certain however rough the sketches are. Slices below it are counted, not read; only slices that
meet it are, and the values inside it are ranked."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.operators.quantile import CELLS, ranked_in_cells, unpivot
from clientela.sources.staging import broadcast_if_bounded, staged

SLICES = 1_024   # of a month, group and column; a power of two
RUNS = 64        # folders of a month; each holds SLICES / RUNS slices of every group
SKETCH = 4_096   # items a sketch keeps
CUT_ROWS = 2_000   # lists of cuts that may be broadcast, 16 MB


def month_values(rows: DataFrame, cols: Sequence[str], by: Sequence[str] = (), period: str = "Periodo") -> DataFrame:
    """(period, by..., columna, tramo, corte, valor, veces): every distinct value of a column in a month
    and group, with its slice `corte`, the run of slices `tramo`, and how often it occurs. Null and
    NaN values, and rows without a period or group, are left out."""
    keys = [period, *by, "columna"]
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    long = unpivot(rows, cols, [period, *by]).where(f"valor IS NOT NULL AND NOT isnan(valor) AND {known}")
    merged = staged(long.groupBy(*keys, "valor").agg(F.count(F.lit(1)).alias("veces")), "month-values")
    marks = ", ".join(f"{i / SLICES!r}D" for i in range(1, SLICES))
    cuts = merged.groupBy(*keys).agg(F.expr(f"kll_sketch_agg_double(valor, {SKETCH})").alias("_s")).select(
        *keys, F.expr(f"kll_sketch_get_quantile_double(_s, array({marks}))").alias("_cuts"))
    placed = merged.join(broadcast_if_bounded(cuts, CUT_ROWS), keys).withColumn("_a0", F.lit(0))
    for i in range(1, SLICES.bit_length()):  # halving, a column a step: these are compiled, a lambda is not
        half = SLICES >> i
        placed = placed.withColumn(f"_a{i}", F.expr(f"if(_cuts[_a{i - 1} + {half - 1}] < valor, _a{i - 1} + {half}, _a{i - 1})"))
    corte = f"_a{SLICES.bit_length() - 1}"
    return placed.selectExpr(*[f"`{k}`" for k in keys], f"int({corte} div {SLICES // RUNS}) AS tramo", f"{corte} AS corte", "valor", "veces")


def store_months(values: DataFrame, folder: str, period: str = "Periodo") -> None:
    """Write `month_values` in place of what the folder holds for its months, values by month and run
    of slices, slices by month. Months that are not among the values stay as they are."""
    by = [c for c in values.columns if c not in (period, "tramo", "corte", "valor", "veces", "columna")]
    held = staged(values, "months", by=period)  # a month's write reads the month
    slices = staged(held.groupBy(period, *by, "columna", "tramo", "corte").agg(
        F.sum("veces").alias("n"), F.min("valor").alias("desde"), F.max("valor").alias("hasta")), "slices")
    # One folder a month is replaced as a whole, so a run of slices that is no longer there goes too.
    for (month,) in held.select(period).distinct().orderBy(period).collect():  # months of one run
        mine = F.col(period) == F.lit(month)
        (held.where(mine).drop(period).repartition("tramo").sortWithinPartitions("tramo", "columna", "corte", "valor").write
         .mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("tramo").parquet(f"{folder}/values/{period}={month}"))
        (slices.where(mine).drop(period).coalesce(1).write.mode("overwrite").parquet(f"{folder}/slices/{period}={month}"))


def stored_months(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(values, slices) of all stored months."""
    return spark.read.parquet(f"{folder}/values"), spark.read.parquet(f"{folder}/slices")


def quantiles_of_months(values: DataFrame, slices: DataFrame, ps: Sequence[float], by: Sequence[str] = (),
                        period: str = "Periodo", interpolate: bool = True) -> DataFrame:
    """Rows (by..., columna, p, n, valor) over the months of `values` and `slices`, which must be the
    same: the quantile by linear interpolation, or the lower order statistic if not `interpolate`.

    The slices of a group (months x SLICES) are ordered in one task. Values are read from the months
    and runs of slices that meet a bracket; with few groups these prune the folders at run time."""
    keys = [*by, "columna"]
    names = [f"`{k}`" for k in keys]
    part = ", ".join(names)
    sums = slices.selectExpr(
        *names, "desde", "hasta", f"sum(n) OVER (PARTITION BY {part}) AS n",
        f"sum(n) OVER (PARTITION BY {part} ORDER BY desde RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _most",
        f"sum(n) OVER (PARTITION BY {part} ORDER BY hasta RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _least")
    aggs = []
    for i, p in enumerate(ps):
        at = f"CAST(floor({p!r}D * (n - 1)) AS BIGINT)"
        aggs += [F.expr(f"min(desde) FILTER (WHERE _most >= {at} + 1)").alias(f"_lo{i}"),
                 F.expr(f"min(hasta) FILTER (WHERE _least >= least({at} + 2, n))").alias(f"_hi{i}")]
    inline = ", ".join(f"named_struct('i', {i}, 'lo', _lo{i}, 'hi', _hi{i})" for i in range(len(ps)))
    brackets = broadcast_if_bounded(sums.groupBy(*keys).agg(F.max("n").alias("n"), *aggs).selectExpr(*names, "n", f"inline(array({inline}))"))
    met = slices.withColumnRenamed("n", "_n").join(brackets, keys).where("desde <= hi")
    below = met.where("hasta < lo").groupBy(*keys, "i").agg(F.sum("_n").alias("_c"), F.max("n").alias("n"))
    wanted = broadcast_if_bounded(met.where("hasta >= lo").select(period, *keys, "tramo", "corte", "i", "lo", "hi", "n"))
    inside = values.join(wanted.where("corte >= 0"), [period, *keys, "tramo", "corte"]).where("valor <= hi")
    cell = f"if(hi > lo, least(floor((valor - lo) / (hi - lo) * {CELLS}), {CELLS - 1}), 0)"
    counted = (inside.selectExpr(*names, "i", "n", "veces", "if(valor >= lo, valor, null) AS _v", f"if(valor >= lo, {cell}, -1) AS _cell")
               .unionByName(below.selectExpr(*names, "i", "n", "_c AS veces", "CAST(null AS DOUBLE) AS _v", "CAST(-1 AS BIGINT) AS _cell"))
               .groupBy(*keys, "i", "_cell", "_v").agg(F.sum("veces").alias("_c"), F.max("n").alias("n")))
    return ranked_in_cells(counted, keys, ps, interpolate)
