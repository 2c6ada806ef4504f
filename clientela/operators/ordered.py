"""Neighbouring rows and ordered texts inside groups that may be very large."""

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientela.sources.staging import freed, staged

HOT_ROWS = 1_000_000   # rows of one key that a single task may sort
PIECE_ROWS = 1_000_000   # in a piece: many small keys share one
EDGE_ROWS = 50   # compared for each piece to set where it begins


def order_key(cols: Sequence[str]) -> Column:
    """One comparable value for several columns. Nulls of the first sort last; those of the tie
    columns after it sort first."""
    first = F.col(cols[0])
    return F.struct(first.isNull().alias("k"), first.alias("k0"),
                    *[F.col(c).alias(f"k{i}") for i, c in enumerate(cols[1:], 1)])


def ordering(cols: Sequence[str]) -> list[Column]:
    """The same order for a window."""
    return [F.col(cols[0]).asc_nulls_last(), *[F.col(c).asc() for c in cols[1:]]]


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """(_h, _rows): hashes and counts of all keys with more than `rows` rows. Counts merge before
    the shuffle, so this is one narrow pass whatever the skew."""
    counts = df.select(F.xxhash64(*keys).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > rows)


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole last row of each key. An aggregate rather than a window: rows collapse before
    the shuffle, so a key that holds much of the table costs no more than any other."""
    return _edge_row(df, key, order, F.max_by)


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Whole first row of each key."""
    return _edge_row(df, key, order, F.min_by)


def _edge_row(df, key, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    edge = df.groupBy(*key).agg(pick(row, order_key(order)).alias("_row"))
    return edge.select(*key, "_row.*").select(*[F.col(f"`{c}`") for c in df.columns])


def neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
              out: str, forward: bool = False, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `out`: a struct of `values` from the row before (or after) within its key, null if
    there is none. A row with a null in its key has none: null equals nothing. Such rows are
    spread over tasks.

    If a key has more than `hot_rows` rows, counted exactly, all rows are dealt by range of (key, order)
    into pieces of about PIECE_ROWS rows, whatever `hot_rows` is, that are sorted apart, also where many
    rows share a time. A piece begins at a row of the table, which is kept: so the row across a piece
    boundary is known without another pass, and rows are shuffled once. Else it is a plain window.
    Rows equal in `order` follow by `values` in pieces. With pieces `df` is read four times, so it should
    be stored."""
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    spread = F.when(~known, F.xxhash64(*order))
    shift, packed = (F.lead if forward else F.lag), F.struct(*values)
    rows = df.where(known)
    with freed(df.sparkSession):
        most, total = hot_keys(rows, keys, 0).agg(F.max("_rows"), F.sum("_rows")).first()
    if not total or most <= hot_rows:
        window = Window.partitionBy(*keys, "_loose").orderBy(*ordering(order))
        near = df.withColumn("_loose", spread).withColumn(out, F.when(known, shift(packed).over(window)))
        return near.select(*df.columns, out)
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PIECE_ROWS + 1)
    place = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(keys)], order_key([*order, *values]).alias("o"))
    edges = staged(_edges(rows, place, packed, parts, total), "hot-rows")
    dealt = _dealt(rows, edges, place, parts, forward).repartition(parts, "_chunk", *keys)
    window = Window.partitionBy("_chunk", *keys).orderBy(*ordering([*order, *values]))
    across = edges.select(*[F.col(f"_at.p{i}").alias(c) for i, c in enumerate(keys)],
                          (F.col("_chunk") - int(forward)).alias("_chunk"), "_edge")
    joined = (dealt.withColumn("_in", shift(packed).over(window))
              .join(F.broadcast(across), [*keys, "_chunk"], "left").withColumn(out, F.coalesce("_in", "_edge")))
    loose = df.where(~known).withColumn(out, F.lit(None).cast(joined.schema[out].dataType))
    return joined.select(*df.columns, out).unionByName(loose.select(*df.columns, out))


def _edges(rows: DataFrame, place: Column, packed: Column, parts: int, total: int) -> DataFrame:
    """(_chunk, _at, _edge): the rows at which all pieces but the first begin, about equally far apart. Only where
    pieces begin is read off some rows, as when Spark deals by range; every row is dealt."""
    some = rows.sample(min(1.0, EDGE_ROWS * parts / total), 1).agg(F.array_sort(
        F.collect_list(F.struct(place.alias("_at"), packed.alias("_edge"))),
        lambda a, b: F.when(a["_at"] < b["_at"], -1).when(a["_at"] > b["_at"], 1).otherwise(0)).alias("_some"))
    even = some.select(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.get(
        "_some", F.floor(i * F.size("_some") / parts).cast("int"))).alias("_even"))
    apart = even.select(F.filter("_even", lambda e, i: (i > 0) & (e["_at"] > F.get("_even", i - 1)["_at"])).alias("_apart"))
    return apart.select(F.posexplode("_apart").alias("_n", "_e")).select((F.col("_n") + 1).alias("_chunk"), "_e.*")


def _dealt(rows: DataFrame, edges: DataFrame, place: Column, parts: int, forward: bool) -> DataFrame:
    """Add `_chunk`, the number of a row's piece, found by halves in the sorted edges. An edge is the first row of its
    piece; looking back it is the last of the piece before. SQL allows no subquery within a function of functions,
    so the edges come as a column, which the optimizer takes in."""
    held = rows.select("*", place.cast(edges.schema["_at"].dataType).alias("_at"),
                       edges.agg(F.array_sort(F.collect_list("_at"))).scalar().alias("_edges"))
    steps = F.array(*[F.lit(1 << n) for n in reversed(range(parts.bit_length()))])

    def search(at: Column) -> Column:
        def further(n: Column, step: Column) -> Column:
            edge = F.get("_edges", n + step - 1)
            return F.when(edge <= at if forward else edge < at, n + step).otherwise(n)
        return F.aggregate(steps, F.lit(0), further)

    found = F.get(F.transform(F.array("_at"), search), F.lit(0))  # `place` is built once a row
    return held.select(*rows.columns, found.alias("_chunk"))


def joined_text(df: DataFrame, keys: Sequence[str], text: str, at: str, out: str,
                distinct: bool = True, style: str = "joined",
                only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Texts of each key by time `at`, then alphabetically, as one string. `only` picks the keys
    whose texts are built, of the merged rows; of the rows themselves where repeats are kept, as they
    merge into nothing smaller.

    `distinct` keeps the first sight of each text; repeats are merged before the shuffle, so a
    group holds no more elements than there are different texts. With repeats kept, the texts of
    each day are joined first and the days then put in order. `style="list"` gives the
    bracketed, quoted form without commas."""
    known = df.filter(F.col(text).isNotNull())
    if distinct:
        part = known.groupBy(*keys, text).agg(F.min(at).alias("_at"))
    else:
        if only is not None:
            picked, only = only(known), None
            known = known.join(picked, picked.columns, "left_semi")
        daily = known.select(*keys, text, F.col(at).alias("_at"), F.col(at).cast("date").alias("_day"))
        part = (daily.groupBy(*keys, "_day").agg(_sorted_join(text).alias(text))
                .withColumnRenamed("_day", "_at"))
    if only is not None:
        picked = only(part)
        part = part.join(picked, picked.columns, "left_semi")
    if style == "list":
        quoted = F.concat(F.lit("'"), F.col(text), F.lit("'"))
        body = part.withColumn(text, quoted).groupBy(*keys).agg(_sorted_join(text, " ").alias(out))
        return body.withColumn(out, F.concat(F.lit("["), F.col(out), F.lit("]")))
    return part.groupBy(*keys).agg(_sorted_join(text).alias(out))


def _sorted_join(text: str, sep: str = ", ") -> Column:
    ordered = F.array_sort(F.collect_list(F.struct("_at", text)))
    return F.array_join(F.transform(ordered, lambda e: e[text]), sep)
