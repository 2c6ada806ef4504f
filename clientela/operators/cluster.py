"""Scaling, k-means and cluster names."""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientela import contracts as C
from clientela.operators.quantile import exact_quantiles, unpivot
from clientela.operators.relational import lookup_join
from clientela.sources.staging import staged

CLUSTER = "rfm_cluster"
MOST_CLUSTERS = 10_000
FEW_POINTS = 50_000   # moved by one task
SCALED = tuple(f"{c}_z" for c in C.RFM_COLS)


def standardize(df: DataFrame, cols: Sequence[str] = C.RFM_COLS, suffix: str = "_z") -> DataFrame:
    """Add (x - mean) / population deviation of each column; 0 for a constant column."""
    stats = df.agg(*[a for c in cols for a in (
        F.avg(c).alias(f"_m_{c}"), F.stddev_pop(c).alias(f"_s_{c}"))])
    joined = df.crossJoin(F.broadcast(stats))
    scaled = [
        F.when(F.col(f"_s_{c}") > 0, (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}"))
        .otherwise(F.lit(0.0)).alias(f"{c}{suffix}") for c in cols]
    return joined.select(*df.columns, *scaled)


def nearest(cols: Sequence[str], centroids: Sequence[Sequence[float]]) -> Column:
    """Index of the nearest centroid; the lowest index on a tie."""
    options = []
    for i, centre in enumerate(centroids):
        gaps = [f"(`{c}` - {float(v)!r}D)" for c, v in zip(cols, centre)]
        distance = " + ".join(f"{g} * {g}" for g in gaps)
        options.append(f"named_struct('d', {distance}, 'i', {i})")
    return F.expr(f"least({', '.join(options)}).i" if len(options) > 1 else "0")


def _few(clusters: DataFrame) -> DataFrame:
    """The rows, or an error if there are too many to travel as one."""
    count = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    capped = clusters.limit(MOST_CLUSTERS + 1).withColumn("_n", count)
    return capped.where(F.when(F.col("_n") <= MOST_CLUSTERS, True).otherwise(
        F.raise_error(F.lit(f"more than {MOST_CLUSTERS} clusters")).cast("boolean"))).drop("_n")


def kmeans_assign(df: DataFrame, cols: Sequence[str], centroids: DataFrame,
                  out: str = CLUSTER) -> DataFrame:
    """Nearest row of `centroids` (cluster, cols...). The k centroids travel as one row."""
    packed = _few(centroids).agg(F.collect_list(F.struct(
        F.col("cluster").alias("i"), *[F.col(c).alias(f"c{n}") for n, c in enumerate(cols)]))
        .alias("_cs"))

    def distance(centre):
        total = F.lit(0.0)
        for n, c in enumerate(cols):
            total = total + F.pow(F.col(c) - centre[f"c{n}"], 2)
        return F.struct(total.alias("d"), centre["i"].alias("i"))

    joined = df.crossJoin(F.broadcast(packed))
    best = F.array_min(F.transform("_cs", distance))["i"]
    return joined.select(*df.columns, best.alias(out))


def rank_seeds(df: DataFrame, cols: Sequence[str], k: int, by: str, id_col: str) -> list[list[float]]:
    """k different starting centroids: the rows at evenly spread ranks of the different values of
    `by`, the smallest id where several rows share one. With too few values, the first different
    points by (`by`, cols). Fewer than k different points are an error."""
    values = df.groupBy(by).agg(F.min_by(F.struct(*cols), F.col(id_col)).alias("_row"))
    ps = [(2 * i + 1) / (2 * k) for i in range(k)]
    marks = exact_quantiles(unpivot(values, [by]), ["columna"], ps, bounded_keys=True, interpolate=False)
    hits = values.join(F.broadcast(marks.select("valor").distinct()), F.col(by).cast("double") == F.col("valor"))
    rows = hits.orderBy("valor").select("_row.*").collect()
    if len(rows) < k:
        rows = df.select(by, *cols).distinct().orderBy(by, *cols).limit(k).collect()
    seeds = [[float(row[c]) for c in cols] for row in rows]
    if len(seeds) < k:
        raise ValueError(f"{k} clusters asked for, {len(seeds)} different points")
    return seeds


def weighted_points(df: DataFrame, cols: Sequence[str], id_col: str) -> DataFrame:
    """Different points with the number of rows at each and the least id there. Rows with a null
    coordinate move no centroid."""
    return (df.select(id_col, *[F.col(f"`{c}`").cast("double").alias(f"x{n}") for n, c in enumerate(cols)]).na.drop(
        subset=[f"x{n}" for n in range(len(cols))])
        .groupBy(*[f"x{n}" for n in range(len(cols))]).agg(F.count(F.lit(1)).alias("w"), F.min(id_col).alias("id")))


def _fixed(points: DataFrame, dims: int) -> tuple[list[Column], float]:
    """Coordinates times weights as whole multiples of a power of two, and that power: sums of 64-bit
    integers do not depend on the order of rows. The power leaves room for the sum of all."""
    total = points.agg(F.sum(sum(F.abs(F.col(f"x{n}")) * F.col("w") for n in range(dims)))).first()[0] or 0.0
    if not math.isfinite(total):
        raise ValueError("coordinates are too large to add; scale them first")
    unit = 2.0 ** min(1000, 61 - math.frexp(total)[1])
    return [F.rint(F.col(f"x{n}") * F.col("w") * F.lit(unit)).cast("bigint").alias(f"f{n}") for n in range(dims)], unit


def round_sums(rows: DataFrame, centres: dict[int, Sequence[Sequence[float]]]) -> DataFrame:
    """(s, i, w, d, f...): weight, cost and coordinate sums of the points nearest to each centroid `i` of
    each start `s`; the lowest index on a tie. A start's centroids travel as a row of data and points meet
    one start at a time, so every round runs the same code, short enough to be compiled however many
    starts there are."""
    k, dims = max(map(len, centres.values())), len(next(iter(centres.values()))[0])
    names = [[f"c{i}_{n}" for n in range(dims)] for i in range(k)]
    # A start with fewer centroids repeats its last one, which loses the tie with itself.
    cells = {s: [repr(float(x)) + "D" for c in [*cs, *[cs[-1]] * (k - len(cs))] for x in c] for s, cs in centres.items()}
    table = rows.sparkSession.sql(f"""SELECT * FROM VALUES {', '.join(f"({', '.join([str(s), *c])})" for s, c in cells.items())}
        AS t(s, {', '.join(x for c in names for x in c)})""")
    kept = ["s", "w", *(f"f{n}" for n in range(dims))]
    distances = [f"{' + '.join(f'(x{n} - {x}) * (x{n} - {x})' for n, x in enumerate(c))} AS d{i}" for i, c in enumerate(names)]
    least = f"least({', '.join(f'd{i}' for i in range(k))})" if k > 1 else "d0"
    index = f"CASE {' '.join(f'WHEN d{i} = d THEN {i}' for i in range(k - 1))} ELSE {k - 1} END" if k > 1 else "0"
    met = rows.crossJoin(F.broadcast(table)).selectExpr(*kept, *distances).selectExpr("*", f"{least} AS d")
    return met.selectExpr(*kept, "d", f"{index} AS i").groupBy("s", "i").agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("d")).alias("d"), *[F.sum(f"f{n}").alias(f"f{n}") for n in range(dims)])


def move_centroids(points: DataFrame, starts: Sequence[Sequence[Sequence[float]]], iters: int,
                   tol: float = 1e-9) -> list[tuple[float, list[list[float]]]]:
    """(cost, centroids) of each start after Lloyd rounds until none of its centroids moves more than
    `tol`, at most `iters`. `points` is a stored `weighted_points`.

    All starts move in the same aggregation, so there are as many passes as the longest takes;
    starts that have come to rest leave it. Only starts x k rows return to the driver."""
    dims = len(starts[0][0])
    fixed, unit = _fixed(points, dims)
    centres = [[list(c) for c in start] for start in starts]
    live, cost = [True] * len(starts), [float("inf")] * len(starts)
    few = points.limit(FEW_POINTS + 1).count() <= FEW_POINTS
    rows = (points.coalesce(1) if few else points).select("*", *fixed)  # a task needs no exchange
    for _ in range(iters):
        found = round_sums(rows, {s: c for s, c in enumerate(centres) if live[s]}).collect()
        moved = {s: [list(c) for c in centres[s]] for s in range(len(starts)) if live[s]}
        total = dict.fromkeys(moved, 0.0)
        for r in found:
            moved[r.s][r.i] = [r[f"f{n}"] / unit / r.w for n in range(dims)]
            total[r.s] += r.d
        for s, new in moved.items():
            shift = max(abs(a - b) for old, c in zip(centres[s], new) for a, b in zip(old, c))
            centres[s], cost[s], live[s] = new, total[s], shift > tol
        if not any(live):
            break
    return list(zip(cost, centres))


def kmeans_lloyd(df: DataFrame, cols: Sequence[str] = SCALED, k: int = 3, iters: int = 300,
                 by: str = "ValorMonetario", id_col: str = "mail", out: str = CLUSTER,
                 tol: float = 1e-9) -> DataFrame:
    """Deterministic k-means: rank seeds, then rounds until no centroid moves more than `tol`, at
    most `iters`. The input is written to the staging folder first; a round scans its different
    points. Means are of integer sums, which do not depend on the order of rows."""
    data = staged(df, "lloyd")
    seeds = rank_seeds(data, cols, k, by, id_col)
    points = staged(weighted_points(data, cols, id_col), "points")
    [(_, centres)] = move_centroids(points, [seeds], iters, tol)
    return data.withColumn(out, nearest(cols, centres))


def hash_seeds(points: DataFrame, k: int, seed: int, n_init: int) -> list[list[list[float]]]:
    """Starting centroids of each start: the k different points whose least id has the least MD5
    together with the number of the start."""
    dims = [c for c in points.columns if c.startswith("x")]
    each = None
    for s in range(n_init):
        mark = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed + s}")).cast("binary"))
        some = points.select(F.lit(s).alias("s"), mark.alias("m"), *dims).orderBy("m").limit(k)
        each = some if each is None else each.unionByName(some)
    rows = each.collect()  # n_init * k
    return [[[r[c] for c in dims] for r in sorted((r for r in rows if r.s == s), key=lambda r: r.m)] for s in range(n_init)]


def kmeans(df: DataFrame, cols: Sequence[str] = SCALED, k: int = 3, max_iter: int = 300,
           seed: int = 42, n_init: int = 10, out: str = CLUSTER, id_col: str = "mail", tol: float = 1e-9) -> DataFrame:
    """Best of `n_init` k-means starts by cost, then nearest-centre labels. Starts are chosen by hash,
    so a repeated run gives the same clusters; these are numbered in the order of their centroids.
    With fewer than k different points there are as many clusters as points; none is an error."""
    data = staged(df, "kmeans")
    points = staged(weighted_points(data, cols, id_col), "points")
    starts = hash_seeds(points, k, seed, n_init)
    if not starts[0]:
        raise ValueError("no point to start from")
    _, centres = min(move_centroids(points, starts, max_iter, tol), key=lambda found: found[0])
    return data.withColumn(out, nearest(cols, sorted(centres)))


def cluster_stats(rfm: DataFrame, by: str = CLUSTER, monetary: str = "ValorMonetario") -> DataFrame:
    """min / max / mean of the three measures per cluster."""
    named = (("Recencia", "Recencia"), ("Frecuencia", "Frecuencia"), ("Monetario", monetary))
    return rfm.filter(F.col(by).isNotNull()).groupBy(by).agg(*[
        agg(col).alias(f"{name} {tag}") for name, col in named
        for agg, tag in ((F.min, "Min"), (F.max, "Max"), (F.avg, "Media"))])


def cluster_means(rfm: DataFrame, by: str = CLUSTER, cols: Sequence[str] = C.RFM_COLS) -> DataFrame:
    return (rfm.filter(F.col(by).isNotNull()).groupBy(by)
            .agg(*[F.avg(c).alias(c) for c in cols]))


def argmax_group(stats: DataFrame, by: str = CLUSTER) -> DataFrame:
    """Clusters of greatest mean value and of greatest mean recency; the lowest id on a tie."""
    first = lambda c: F.max_by(by, F.struct(F.col(c), -F.col(by)))
    return stats.agg(first("ValorMonetario").alias("mayor_monetario"),
                     first("Recencia").alias("mayor_recencia"))


def name_clusters(means: DataFrame, rule: str = "v1", by: str = CLUSTER) -> DataFrame:
    """(cluster, rfm) from the per-cluster means.

    v1: the strictly greatest mean value is loyal, else the last cluster; of the rest the
    greater recency is lost (the later one on a tie), the other at risk. Every cluster gets a
    name. v2: greatest value and greatest recency are picked apart; if they coincide, "lost"
    wins and one cluster stays without a name."""
    rows = _few(means).agg(F.array_sort(F.collect_list(F.struct(
        F.col(by).alias("i"), F.col("ValorMonetario").alias("m"), F.col("Recencia").alias("r"))))
        .alias("a"))
    if rule == "v1":
        best = F.filter("a", lambda x: x["m"] == F.array_max(F.transform("a", lambda y: y["m"])))
        with_loyal = rows.withColumn("loyal", F.when(F.size(best) == 1, best[0]["i"]).otherwise(
            F.array_max(F.transform("a", lambda x: x["i"]))))
        rest = F.filter("a", lambda x: x["i"] != F.col("loyal"))
        lost = F.array_max(F.transform(rest, lambda x: F.struct(x["r"], x["i"].alias("i"))))["i"]
        picked = with_loyal.withColumn("lost", lost)
    elif rule == "v2":
        def top(field):
            order = F.transform("a", lambda x: F.struct(x[field], (-x["i"]).alias("i")))
            return -F.array_max(order)["i"]
        picked = rows.withColumn("loyal", top("m")).withColumn("lost", top("r"))
    else:
        raise ValueError(f"unknown rule {rule!r}")
    others = F.filter("a", lambda x: (x["i"] != F.col("loyal")) & (x["i"] != F.col("lost")))
    each = picked.withColumn("risk", F.array_min(F.transform(others, lambda x: x["i"]))).select(
        "loyal", "lost", "risk", F.explode(F.transform("a", lambda x: x["i"])).alias(by))
    label = (F.when(F.col(by) == F.col("lost"), C.LOST).when(F.col(by) == F.col("loyal"), C.LOYAL)
             .when(F.col(by) == F.col("risk"), C.AT_RISK))
    return each.select(by, label.alias("rfm"))


def label_clusters(clustered: DataFrame, rule: str = "v1", by: str = CLUSTER) -> DataFrame:
    """Attach the business name of each row's cluster. The lookup has one row per cluster."""
    return lookup_join(clustered, F.broadcast(name_clusters(cluster_means(clustered, by), rule, by)), by)
