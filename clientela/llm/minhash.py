"""Near-duplicate documents by one-permutation MinHash.

One hash per shingle falls into one of BANDS * ROWS bins; the least value of a bin is its entry.
Empty bins borrow from another bin of the document, each along a random order of bins of its own
(optimal densification), so short texts keep unbiased, independent bands. Documents that share a
band meet in a bucket; a bucket yields edges of a star around one member, not all pairs. Edges are
confirmed on the full shingle sets. What stars leave open, buckets with members in different
components, is settled exactly: such members are compared where the rarest of their shingles meet
and the positions there still allow the similarity."""

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.llm.graph import components
from clientela.llm.store import empty, keep, mapped, renamed
from clientela.llm.textbytes import Piece, mix, shingle_sets, slices

WORDS = 5           # per shingle
PERCENT = 75        # least similarity of a link
BANDS, ROWS = 64, 6  # a pair of similarity 0.75 shares no band with probability 4e-6
STARS = 2           # rounds of stars before the exact comparison of the rest


@cache
def _orders() -> tuple[np.ndarray, np.ndarray]:
    """For each bin, a random order of all bins; and the rank of each bin in that order."""
    n = BANDS * ROWS
    order = np.random.default_rng(7).permuted(np.tile(np.arange(n, dtype=np.int16), (n, 1)), axis=1)
    return order, np.argsort(order, axis=1).astype(np.int16)


def densify(entries: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Give each empty bin the entry of the first filled bin in its order. Rows without any
    filled bin stay as they are."""
    order, rank = _orders()
    bins = entries.shape[1]
    out = entries.copy()
    for row in np.flatnonzero(~filled.all(1) & filled.any(1)):
        holes, full = np.flatnonzero(~filled[row]), np.flatnonzero(filled[row])
        if len(full) * len(full) < bins:  # few filled: least rank among them
            out[row, holes] = entries[row, full[rank[holes][:, full].argmin(1)]]
        else:
            step = 0
            while len(holes):
                source = order[holes, step]
                hit = filled[row, source]
                out[row, holes[hit]] = entries[row, source[hit]]
                holes, step = holes[~hit], step + 1
    return out


def signatures(rows: np.ndarray, hashes: np.ndarray, n_rows: int) -> np.ndarray:
    """Band hashes (n_rows, BANDS) of shingle sets given as ascending (row, hash)."""
    bins = BANDS * ROWS
    # 32 upper bits choose the bin: ascending hashes give ascending bins, so firsts are minima
    bin_of = ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = rows * bins + bin_of
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    entries, filled = np.zeros(n_rows * bins, np.uint64), np.zeros(n_rows * bins, bool)
    entries[cell[first]], filled[cell[first]] = hashes[first], True
    entries = densify(entries.reshape(n_rows, bins), filled.reshape(n_rows, bins))
    with np.errstate(over="ignore"):
        bands = np.zeros((n_rows, BANDS), np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)
        for i in range(ROWS):
            bands = mix(bands + entries[:, i::ROWS])
    return bands


def _sums(values: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Sum of each row's values modulo 2**64."""
    with np.errstate(over="ignore"):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        ends = np.cumsum(np.bincount(rows, minlength=n_rows))
        return total[ends] - total[ends - np.bincount(rows, minlength=n_rows)]


def _profiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        n = part.num_rows
        rows, hashes = shingle_sets(Piece(part), WORDS)
        sizes = np.bincount(rows, minlength=n)
        digests = [_sums(mix(hashes ^ np.uint64(salt)), rows, n) for salt in (0, 0x5851F42D4C957F2D)]
        bands = signatures(rows, hashes, n)
        yield pa.record_batch({
            "id": part.column(0), "n": pa.array(sizes, pa.int64()),
            "d1": pa.array(digests[0].view(np.int64)), "d2": pa.array(digests[1].view(np.int64)),
            "bands": pa.ListArray.from_arrays(
                np.arange(0, (n + 1) * BANDS, BANDS, dtype=np.int32), bands.view(np.int64).ravel())})


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        rows, hashes = shingle_sets(Piece(part), WORDS)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=part.num_rows))])
        yield pa.record_batch({"id": part.column(0), "shingles": pa.ListArray.from_arrays(
            bounds.astype(np.int32), hashes.view(np.int64))})


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b").withColumn("both", both)
            .where(100 * F.col("both") >= PERCENT * (F.size("sa") + F.size("sb") - F.col("both")))
            .select("a", "b").distinct())


def _sized() -> "F.Column":
    """Necessary for a link: sizes differ by no more than the similarity allows."""
    return (100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Linked are texts with 100 * intersection >= 75 * union of their sets of 5-word shingles, A-Z
    lower-cased; a text of fewer words has its whole sequence as one shingle. component_id is the
    smallest id that links reach, kept says that it is the row's own id. Texts that are null,
    empty or without words have no shingle and are linked with nothing, as are rows without an id
    (component_id null, kept true). Rows that repeat an id count as one document with one id and
    are each returned. Sets are compared by 64-bit hashes of their shingles.

    Equal sets are merged by digest first, so large groups of copies cost one row each."""
    docs = renamed(docs, id_col, text_col)
    kind = docs.schema["id"].dataType.simpleString()
    profile = keep(mapped(docs, _profiles, f"id {kind}, n long, d1 long, d2 long, bands array<long>"), "profile")
    known = profile.where("id IS NOT NULL AND n > 0")
    groups = keep(known.groupBy("d1", "d2", "n").agg(F.min("id").alias("head"), F.count("*").alias("copies")),
                  "groups")
    copies = (known.select("id", "d1", "d2", "n").join(groups.where("copies > 1"), ["d1", "d2", "n"])
              .where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")))

    heads = groups.where("n >= 3").select(F.col("head").alias("id"), "d1", "d2")  # smaller sets link to equals only
    heads = known.join(heads, ["id", "d1", "d2"], "left_semi").select("id", "n", "bands")
    banded = heads.select("id", "n", F.explode("bands").alias("bucket"))
    shared = (banded.groupBy("bucket").agg(F.count("*").alias("members"), F.min("id").alias("least"),
                                           F.max("id").alias("most"))
              .where("least < most").select("bucket", "members"))
    members = keep(banded.join(shared, "bucket"), "members").distinct()
    return _labelled(profile, keep(copies.union(_linked(docs, members)), "links"), id_col)


def _linked(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Confirmed edges that connect what the buckets of `members` connect."""
    spark = docs.sparkSession
    kind = docs.schema["id"].dataType.simpleString()
    weights = members.groupBy("id").agg(F.sum("members").alias("weight"))
    sets = keep(mapped(docs.join(weights.select("id"), "id", "left_semi"), _sets,
                       f"id {kind}, shingles array<long>"), "sets")
    members = keep(members.join(weights, "id"), "weighted")
    links = spark.createDataFrame([], f"a {kind}, b {kind}")
    tried = links
    labels = None
    for turn in range(STARS + 1):
        open_members = _open(members, labels)
        if turn < STARS:
            # first around the member with most company, the likeliest original; then at random
            rank = F.col("weight") if turn == 0 else F.xxhash64(F.lit(turn), F.col("id"), F.col("bucket"))
            centers = open_members.groupBy("bucket").agg(
                F.max(F.struct(rank.alias("rank"), "id", "n", "label")).alias("c"))
            sides = open_members.join(centers, "bucket").select(
                F.col("c.id").alias("a"), F.col("id").alias("b"), F.col("c.n").alias("na"),
                F.col("n").alias("nb"), F.col("c.label").alias("la"), F.col("label").alias("lb"))
        else:
            sides = _rest(open_members, sets)
        pairs = (sides.where("la <> lb").where(_sized())
                 .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        pairs = keep(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        if empty(pairs):
            if turn < STARS:
                continue
            break
        tried = keep(tried.union(pairs), "tried")
        links = keep(links.union(_confirm(pairs, sets)), "links")
        labels = keep(components(links), "components")
    return links


def _rest(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of members in different components that can be similar enough, none missing. With
    shingles in one order, rare ones first, two such sets share a shingle among the first
    n - 0.75 n + 1 of each, and from the first shared one on enough of both must be left for the
    overlap that the similarity asks for, 3/7 of both sizes."""
    docs = members.select("id", "n", "label").distinct()
    tokens = docs.join(sets, "id").select("id", "n", "label", F.explode("shingles").alias("token"))
    frequency = tokens.groupBy("token").agg(F.count("*").alias("df"))
    ordered = tokens.join(frequency, "token").groupBy("id", "n", "label").agg(
        F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    first = F.expr(f"slice(tokens, 1, n - CAST(ceil(n * {PERCENT} / 100) AS INT) + 1)")
    heads = keep(ordered.select("id", "n", "label", F.posexplode(first).alias("pos", "t"))
                 .where("t.df > 1").select("id", "label", "n", (F.col("n") - F.col("pos")).alias("rest"),
                                           F.col("t.token").alias("token")), "heads")
    left = heads.select("token", F.col("id").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("rest").alias("ra"))
    right = heads.select("token", F.col("id").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("rest").alias("rb"))
    enough = (100 + PERCENT) * F.least("ra", "rb") >= PERCENT * (F.col("na") + F.col("nb"))
    return left.join(right, (left["token"] == right["token"]) & (F.col("a") < F.col("b"))
                     & (F.col("la") != F.col("lb")) & _sized() & enough)


def _open(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members, with the component so far, of buckets that still hold several components."""
    if labels is None:
        return members.withColumn("label", F.col("id"))
    labelled = (members.join(labels.withColumnRenamed("node", "id"), "id", "left")
                .withColumn("label", F.coalesce("component", "id")).drop("component"))
    mixed = (labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
             .where("low < high").select("bucket"))
    return keep(labelled.join(mixed, "bucket", "left_semi"), "open")


def _labelled(profile: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    found = components(links).withColumnRenamed("node", "id")
    component = F.coalesce("component", "id")
    return profile.select("id", "n").join(found, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))
