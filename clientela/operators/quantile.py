"""Exact interpolated quantiles without gathering a group in one task.

The built-in exact `percentile` holds all values of a group in one aggregation buffer. Here a
mergeable sketch first brackets each wanted rank, values are then counted per bracket (merged
before the shuffle), and only the few values inside a bracket are ranked. The sketch decides
where to look, never the answer: ranks are counted on all rows. Where every group is counted to be
small, its values are ranked at once.

A bracket holds about 6 in 10,000 rows of a large group, equal values counted once. It is cut into
CELLS equal cells, counted first, and only the one or two cells with the wanted ranks are ranked, so a
task ranks the values of a cell. The sketch's rank error is bounded, not just likely, and the
bracket is three times as wide."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.sources.staging import broadcast_if_bounded, staged

ACCURACY = 10_000        # sketch rank error: 1 / ACCURACY
MARGIN = 3 / ACCURACY    # bracket half-width in rank share
SMALL = 100_000          # groups up to this size are bracketed whole
CELLS = 1_024            # of a bracket


def unpivot(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form (by..., columna, valor) with numeric values."""
    wide = df.select(*by, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    return wide.unpivot(list(by), list(cols), "columna", "valor")


def _values(long: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys) or "true"
    rows = long.selectExpr(*[f"`{k}`" for k in keys], f"CAST(`{value}` AS DOUBLE) AS _x")
    return rows.where(f"_x IS NOT NULL AND NOT isnan(_x) AND {known}")


def sketch(long: DataFrame, keys: Sequence[str], ps: Sequence[float], value: str = "valor",
           extra: dict[str, str] | None = None) -> DataFrame:
    """Per key the count, range and approximate quantiles around each wanted one, and further
    aggregates of the value `_x`."""
    around = [max(p - MARGIN, 0.0) for p in ps] + [min(p + MARGIN, 1.0) for p in ps]
    marks = ", ".join(f"{a!r}D" for a in around)
    aggs = {"n": "count(_x)", "_min": "min(_x)", "_max": "max(_x)",
            "_q": f"percentile_approx(_x, array({marks}), {ACCURACY})", **(extra or {})}
    rows = _values(long, keys, value)
    return rows.groupBy(*keys).agg(*[F.expr(e).alias(n) for n, e in aggs.items()])


def _small_quantiles(rows: DataFrame, names: Sequence[str], keys: Sequence[str], ps: Sequence[float], interpolate: bool) -> DataFrame:
    """The same rows where no group has more than SMALL values, which are put in order in one cell."""
    held = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("_x")).alias("_a")).where("size(_a) > 0")
    cells = []
    for p in ps:
        rank = f"({p!r}D * (size(_a) - 1))"
        low, high = f"_a[int(floor{rank})]", f"_a[least(int(floor{rank}) + 1, size(_a) - 1)]"
        answer = f"{low} + ({rank} - floor{rank}) * ({high} - {low})" if interpolate else low
        cells.append(f"named_struct('p', {p!r}D, 'n', CAST(size(_a) AS BIGINT), 'valor', {answer})")
    return held.selectExpr(*names, f"inline(array({', '.join(cells)}))")


def exact_quantiles(long: DataFrame, keys: Sequence[str], ps: Sequence[float],
                    value: str = "valor", bounded_keys: bool = False,
                    interpolate: bool = True, sketched: DataFrame | None = None) -> DataFrame:
    """Rows (keys..., p, n, valor): the quantile by linear interpolation between the two
    neighbouring order statistics, or the lower one of them if not `interpolate`.

    `bounded_keys` states that the keys are few by construction (column names), so their
    brackets may be broadcast; otherwise their number is counted first. `sketched` is a stored
    `sketch` for the same arguments."""
    names = [f"`{k}`" for k in keys]
    table = staged(sketch(long, keys, ps, value), "sketch") if sketched is None else sketched
    if (table.agg(F.max("n")).first()[0] or 0) <= SMALL:  # the input is read twice either way
        return _small_quantiles(_values(long, keys, value), names, keys, ps, interpolate)
    # A small group has one bracket, its whole range; a large one has a bracket per quantile.
    wide = "named_struct('i', -1, 'lo', _min, 'hi', _max)"
    narrow = ", ".join(
        f"named_struct('i', {i}, 'lo', {'_min' if p <= MARGIN else f'_q[{i}]'}, "
        f"'hi', {'_max' if p >= 1 - MARGIN else f'_q[{len(ps) + i}]'})" for i, p in enumerate(ps))
    brackets = table.selectExpr(*names, "n", f"if(n <= {SMALL}, array({wide}), array({narrow})) AS _w")
    if bounded_keys or not keys:
        brackets = F.broadcast(brackets)
    elif sketched is None:
        brackets = broadcast_if_bounded(brackets)
    rows = _values(long, keys, value)
    paired = rows.join(brackets, list(keys)) if keys else rows.crossJoin(brackets)
    # One count per value inside a bracket, and one for all values below it (_v null).
    counted = (
        paired.selectExpr(*names, "n", "_x", "inline(_w)").where("_x <= hi")
        .selectExpr(*names, "i", "n", "if(_x >= lo, _x, null) AS _v",
                    f"if(_x >= lo, if(hi > lo, least(floor((_x - lo) / (hi - lo) * {CELLS}), {CELLS - 1}), 0), -1) AS _cell")
        .groupBy(*keys, "i", "_cell", "_v").agg(F.expr("count(1)").alias("_c"), F.expr("max(n)").alias("n")))
    return ranked_in_cells(counted, keys, ps, interpolate)


def ranked_in_cells(counted: DataFrame, keys: Sequence[str], ps: Sequence[float], interpolate: bool = True) -> DataFrame:
    """Rows (keys..., p, n, valor) from counts per value (keys..., i, _cell, _v, _c, n): `i` is the
    number of the bracket's quantile, or -1 for a bracket of all; cell -1, without a value, holds what lies
    below the bracket. Only the cells with the wanted ranks are ranked."""
    names = [f"`{k}`" for k in keys]
    part = ", ".join([*names, "i"])
    filled = (counted.groupBy(*keys, "i", "_cell").agg(F.sum("_c").alias("_in"), F.max("n").alias("n"))
              .selectExpr(*names, "i", "_cell", "n", "_in", f"sum(_in) OVER (PARTITION BY {part} ORDER BY _cell "
                          "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _end"))
    spots = ", ".join(f"named_struct('i', {i}, 'at', CAST(floor({p!r}D * (n - 1)) AS BIGINT))" for i, p in enumerate(ps))
    wanted = (f"exists(array({spots}), s -> (i = -1 OR s.i = i) AND _end >= s.at + 1 "
              "AND _end - _in < least(s.at + 2, n))")
    chosen = filled.where(f"_cell >= 0 AND {wanted}").selectExpr(*names, "i", "_cell", "_end - _in AS _before")
    ranked = (counted.where("_cell >= 0").join(chosen, [*keys, "i", "_cell"]).selectExpr(
        *names, "i", "n", "_v",
        f"_before + sum(_c) OVER (PARTITION BY {part}, _cell ORDER BY _v "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _upto")
        .unionByName(filled.where("_cell < 0").selectExpr(*names, "i", "n", "CAST(null AS DOUBLE) AS _v", "_end AS _upto")))
    aggs, cells = [F.expr("max(n)").alias("n")], []
    for i, p in enumerate(ps):
        mine, at = f"i IN (-1, {i})", f"floor({p!r}D * (n - 1))"
        aggs += [
            F.expr(f"coalesce(max(_upto) FILTER (WHERE {mine} AND _v IS NULL), 0)").alias(f"_u{i}"),
            F.expr(f"min(_v) FILTER (WHERE {mine} AND _upto >= {at} + 1)").alias(f"_a{i}"),
            F.expr(f"min(_v) FILTER (WHERE {mine} AND _upto >= least({at} + 2, n))").alias(f"_b{i}")]
        cells.append(f"named_struct('p', {p!r}D, 'u', _u{i}, 'a', _a{i}, 'b', _b{i})")
    picked = ranked.groupBy(*keys).agg(*aggs).selectExpr(*names, "n", f"inline(array({', '.join(cells)}))")
    rank = "p * (n - 1)"
    answer = f"a + ({rank} - floor({rank})) * (b - a)" if interpolate else "a"
    return picked.selectExpr(
        *names, "p", "n", f"if(u > floor({rank}) OR a IS NULL OR b IS NULL, "
        f"CAST(raise_error('quantile bracket missed its rank') AS DOUBLE), {answer}) AS valor")


def column_quantiles(df: DataFrame, cols: Sequence[str], ps: Sequence[float]) -> DataFrame:
    """Rows (columna, p, n, valor) for the whole frame."""
    return exact_quantiles(unpivot(df, cols), ["columna"], ps, bounded_keys=True)
