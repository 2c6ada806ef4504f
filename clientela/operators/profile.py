"""Descriptive statistics, counts, histograms and the product correlation."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.operators.quantile import column_quantiles, exact_quantiles, sketch, unpivot
from clientela.sources.staging import broadcast_if_bounded, staged

QUARTILES = (0.25, 0.5, 0.75)
CANDIDATES = 100               # values a column that may be its mode
COUNTERS = 8_192               # values a frequent-item sketch follows
MODE_ERROR = 3.5 / COUNTERS    # largest share of rows by which the sketch is off


def describe(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max; one row per (group, column).

    Two passes: the plain aggregates ride along with the quantile sketch, whose few rows are
    kept; the second pass counts around the quartiles."""
    keys = ["columna"] if by is None else [by, "columna"]
    long = unpivot(df, cols, [] if by is None else [by])
    table = broadcast_if_bounded(sketch(long, keys, QUARTILES, extra={
        "mean": "avg(_x)", "std": "stddev_samp(_x)"}))
    quart = _side_by_side(exact_quantiles(long, keys, QUARTILES, sketched=table), keys)
    basic = table.selectExpr(*[f"`{k}`" for k in keys], "n AS count", "mean", "std", "_min AS min",
                             "_max AS max")
    return basic.join(quart, keys, "left")


def _side_by_side(quart: DataFrame, keys: Sequence[str]) -> DataFrame:
    return quart.groupBy(*keys).agg(*[
        F.expr(f"max(valor) FILTER (WHERE p = {p!r}D)").alias(f"q{int(p * 100)}")
        for p in QUARTILES])


def describe_all(df: DataFrame, numeric: Sequence[str], other: Sequence[str]) -> DataFrame:
    """`describe` of numeric columns, plus distinct count, mode and its frequency of the others.
    Of equally frequent values the smallest is the mode."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in other])
    counted = (text.unpivot([], list(other), "columna", "valor")
               .groupBy("columna", "valor").agg(F.count("valor").alias("n")))
    best = F.min_by(F.struct("valor", "n"), F.struct(-F.col("n"), F.col("valor")))
    tops = counted.groupBy("columna").agg(
        F.sum("n").alias("count"), F.count("valor").alias("unique"),
        best.alias("_t")).select("columna", "count", "unique", F.col("_t.valor").alias("top"),
                                 F.col("_t.n").alias("freq"))
    return describe(df, numeric).unionByName(tops, allowMissingColumns=True)


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(columna, count, top, freq): the most frequent value of every column as text, the smallest of
    equally frequent ones, and how often it occurs. A column without values has no row.

    Frequent-item counters, which merge without shuffling values, name CANDIDATES values per column; only
    these are counted exactly. Any other value occurs at most as often as the last candidate is
    estimated, or MODE_ERROR of all rows. Where the best candidate occurs more often it is the mode; the
    other columns are counted in full."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
    long = text.unpivot([], list(cols), "columna", "valor").where("valor IS NOT NULL")
    counters = long.groupBy("columna").agg(
        F.count("valor").alias("count"), F.expr(f"approx_top_k(valor, {CANDIDATES}, {COUNTERS})").alias("_k"))
    likely = staged(counters.selectExpr("columna", "count", "_k.item AS _items", f"""greatest(
        if(size(_k) < {CANDIDATES}, 0, array_min(_k.count)), CAST(ceil(count * {MODE_ERROR!r}D) AS BIGINT)) AS _bound"""), "modes")

    def best(rows: DataFrame) -> DataFrame:
        counted = rows.groupBy("columna", "valor").agg(F.count(F.lit(1)).alias("n"))
        first = F.min_by(F.struct("valor", "n"), F.struct(-F.col("n"), F.col("valor")))
        return counted.groupBy("columna").agg(first.alias("_t")).select(
            "columna", F.col("_t.valor").alias("top"), F.col("_t.n").alias("freq"))

    few = F.broadcast(likely.selectExpr("columna", "explode(_items) AS valor"))  # CANDIDATES a column
    tried = staged(likely.join(best(long.join(few, ["columna", "valor"], "left_semi")), "columna", "left"), "tried")
    sure = tried.where("freq > _bound").select("columna", "count", "top", "freq")
    open_ = [r[0] for r in tried.where("freq IS NULL OR freq <= _bound").select("columna").collect()]
    if not open_:
        return sure
    rest = best(long.where(F.col("columna").isin(open_))).join(F.broadcast(tried.select("columna", "count")), "columna")
    return sure.unionByName(rest.select(*sure.columns))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), col))


def minmax_dates(df: DataFrame, col: str = "fecha") -> DataFrame:
    return df.agg(F.min(col).alias("desde"), F.max(col).alias("hasta"),
                  F.count(F.lit(1)).alias("filas"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def n_distinct(df: DataFrame, *cols: str) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in cols])


def quantiles(df: DataFrame, cols: Sequence[str], ps: Sequence[float]) -> DataFrame:
    return column_quantiles(df, cols, ps).select("columna", "p", "valor")


def onehot_correlation(df: DataFrame, id_col: str, category: str, k: int = 10) -> DataFrame:
    """Long (a, b, corr): Pearson correlation of the k commonest categories' indicators over
    the ids that have any of them.

    Categories become k indicator columns by their rank, so an id is one row however many
    lines it has, no pairs are formed, and one aggregation gives all joint sums. The distinct
    (id, category) rows are stored, since ranking and indicators both read them."""
    pairs = staged(df.select(id_col, category).na.drop().distinct(), "pairs")
    top = (pairs.groupBy(category).agg(F.count(F.lit(1)).alias("ids"))
           .orderBy(F.col("ids").desc(), category).limit(k))
    in_order = F.array_sort(F.collect_list(F.struct((-F.col("ids")).alias("o"), category)))
    names = F.broadcast(top.agg(F.transform(in_order, lambda t: t[category]).alias("_t")))  # one row
    marks = (
        pairs.crossJoin(names).selectExpr(f"`{id_col}`", f"array_position(_t, `{category}`) AS r")
        .where("r > 0").groupBy(id_col)
        .agg(*[F.expr(f"max(if(r = {i + 1}, 1, 0))").alias(f"x{i}") for i in range(k)]))
    sums = marks.agg(F.expr("CAST(count(1) AS DOUBLE)").alias("n"), F.array(*[
        F.expr(f"CAST(sum(x{i} * x{j}) AS DOUBLE)") for i in range(k) for j in range(i, k)]).alias("s"))

    def joint(i: str, j: str) -> str:
        """Element of the upper triangle, stored row by row."""
        lo, hi = f"least({i}, {j})", f"greatest({i}, {j})"
        return f"s[int({lo} * {k} - {lo} * ({lo} - 1) / 2 + {hi} - {lo})]"

    cells = sums.crossJoin(names).selectExpr("n", "s", "_t", f"explode(sequence(0, {k * k - 1})) AS c")
    parts = cells.selectExpr("n", "s", "_t", f"int(c div {k}) AS i", f"int(c % {k}) AS j").where(
        "i < size(_t) AND j < size(_t)").selectExpr(
        "_t[i] AS a", "_t[j] AS b", "i = j AS same", "n", f"{joint('i', 'i')} AS na",
        f"{joint('j', 'j')} AS nb", f"{joint('i', 'j')} AS nab")
    spread = "sqrt(na * (n - na)) * sqrt(nb * (n - nb))"
    return parts.selectExpr("a", "b", f"""CASE WHEN same THEN 1.0D
        WHEN {spread} > 0 THEN (n * nab - na * nb) / ({spread}) END AS corr""")


def matrix_to_long(wide: DataFrame, label: str | None = None) -> DataFrame:
    """Square matrix to (a, b, corr). Without a label column rows are taken to follow the order
    of the columns, which needs a row number `fila` starting at 0."""
    cols = [c for c in wide.columns if c not in (label, "fila")]
    if label is None:
        names = F.array(*[F.lit(c) for c in cols])
        wide = wide.withColumn("_a", F.element_at(names, F.col("fila").cast("int") + 1))
        label = "_a"
    return (wide.select(F.col(f"`{label}`").alias("a"), *[F.col(f"`{c}`") for c in cols])
            .unpivot(["a"], [F.col(f"`{c}`") for c in cols], "b", "corr"))


def long_to_wide(long: DataFrame, names: Sequence[str]) -> DataFrame:
    """(a, b, corr) to one row per `a` and one column per name."""
    return long.groupBy("a").pivot("b", list(names)).agg(F.max("corr"))


def distribution_profile(df: DataFrame, col: str, by: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram of a column per label, over the range of the whole column; the
    tabular form of a violin plot. The quartiles of the label are repeated on its bins. The two
    columns are stored, since range, bins and quartiles read them."""
    x = F.col(f"`{col}`").cast("double")
    kept = staged(df.filter(F.col(by).isNotNull() & x.isNotNull()).select(by, x.alias("x")), "distribution")
    span = kept.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    bin_no = F.when(F.col("hi") > F.col("lo"), F.least(
        F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    hist = (kept.crossJoin(F.broadcast(span)).withColumn("bin", bin_no)
            .groupBy(by, "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
            .select(by, "bin", (F.col("lo") + F.col("bin") * width).alias("desde"), "n"))
    quart = _side_by_side(exact_quantiles(kept, [by], QUARTILES, value="x"), [by])
    return hist.join(broadcast_if_bounded(quart), by)


def density_profile(df: DataFrame, col: str, by: str, bins: int = 256, points: int = 64) -> DataFrame:
    """Gaussian kernel density of a column per label at `points` even places over the range of the
    whole column: the curve that a violin plot draws. Bandwidth is the label's sample deviation times
    n ** -0.2. A label without spread has no curve.

    Values are first counted in `bins` equal bins, which stand at their middles, so the kernels are
    laid over bins x points for each label however many rows it has."""
    x = F.col(f"`{col}`").cast("double")
    kept = staged(df.filter(F.col(by).isNotNull() & x.isNotNull() & ~F.isnan(x)).select(by, x.alias("x")), "density")
    span = kept.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    number = F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))
    hist = (kept.crossJoin(F.broadcast(span)).where("hi > lo").withColumn("bin", number)
            .groupBy(by, "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("n"))
            .select(by, "lo", "hi", (F.col("lo") + (F.col("bin") + 0.5) * width).alias("m"), "n"))
    labels = kept.groupBy(by).agg(F.count(F.lit(1)).alias("total"), F.stddev_samp("x").alias("s"))
    wide = labels.where("s > 0").select(by, "total", (F.col("s") * F.pow("total", F.lit(-0.2))).alias("h"))
    place = F.col("lo") + F.col("punto") * ((F.col("hi") - F.col("lo")) / (points - 1))
    laid = hist.join(wide, by).withColumn("punto", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("x", place)
    away = (F.col("x") - F.col("m")) / F.col("h")
    kernel = F.col("n") * F.exp(-away * away / 2) / (F.col("total") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    return laid.groupBy(by, "punto", "x").agg(F.sum(kernel).alias("densidad"))
