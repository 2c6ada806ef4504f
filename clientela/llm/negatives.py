"""Hard negatives by Fagin's threshold algorithm over blocks of candidates.

Anchors are a stated share of the rows; each block of anchors meets each block of candidates in one
task, where every dimension has its list of candidates sorted by component. An anchor reads each
list from the end that its sign favours, scores what it sees by random access in integers, and
stops once the threshold, the score of a row that would be last seen in every list, is strictly
below the kth score of each of its windows. What blocks return, k rows a window at most, is ranked
again over all blocks."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientela.llm.store import ROOT, keep

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90    # percent of the positive's score
ANCHOR_BLOCK = 4096   # rows, on average
BLOCK = 4096
FIRST_DEPTH = 64
LONG = 1 << 63


class Lists:
    """Candidates of a block with a sorted list of them for each dimension."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.order = np.argsort(rows, axis=0, kind="stable").astype(np.int32)  # ascending in every column
        self.sorted = np.take_along_axis(rows, self.order, axis=0)
        self.read = 0  # rows scored so far

    def scores(self, anchor: np.ndarray, windows: "Windows") -> tuple[np.ndarray, np.ndarray]:
        """Indices and scores of the candidates seen until no unseen one can enter a window."""
        n = len(self.ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, anchor.dtype)
        up = np.flatnonzero(anchor > 0)
        down = np.flatnonzero(anchor < 0)
        seen = np.zeros(n, bool)
        at, found = np.zeros(0, np.int64), np.zeros(0, anchor.dtype)
        done, depth = 0, min(FIRST_DEPTH, n)
        while True:
            fresh = np.zeros(n, bool)
            fresh[self.order[n - depth:n - done, up]] = True
            fresh[self.order[done:depth, down]] = True
            if depth == n:
                fresh[:] = True  # lists without a sign hold the rest
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            self.read += len(new)
            at, found = np.concatenate([at, new]), np.concatenate([found, self.rows[new] @ anchor])
            if depth == n:
                return at, found
            threshold = self.sorted[n - depth, up] @ anchor[up] + self.sorted[depth - 1, down] @ anchor[down]
            if windows.closed(threshold, windows.fits(self.labels[at], self.ids[at]), found):
                return at, found
            done, depth = depth, min(2 * depth, n)


class Windows:
    """Ranges of scores, of each of which the first k candidates are wanted: among those with the
    anchor's label or among the others."""

    def __init__(self, anchor_id: int, label: int, same: bool, bounds: list[tuple[int, int]] | None, k: int):
        self.anchor_id, self.label, self.same, self.bounds, self.k = anchor_id, label, same, bounds, k

    def fits(self, labels: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return (labels == self.label) & (ids != self.anchor_id) if self.same else labels != self.label

    def closed(self, threshold, fits: np.ndarray, found: np.ndarray) -> bool:
        """No unseen row, of the threshold's score at most, can be in a window or tie with its kth."""
        above = found[fits & (found > threshold)]
        if self.bounds is None:
            return len(above) >= self.k
        return all(low > high or threshold < low or np.count_nonzero((above >= low) & (above <= high)) >= self.k
                   for low, high in self.bounds)

    def first(self, lists: Lists, at: np.ndarray, found: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each window its number, and ids and scores of its first k."""
        good = self.fits(lists.labels[at], lists.ids[at])
        ids, scores = lists.ids[at[good]], found[good]
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        for number, (low, high) in enumerate(self.bounds or [(None, None)]):
            inside = slice(None) if low is None else (scores >= low) & (scores <= high)
            yield number, ids[inside][:self.k], scores[inside][:self.k]


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers; shorter vectors are filled with zeros. 64-bit integers where inner products
    fit, else integers of any size."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py():vectors.offsets[-1].as_py()]
    out = np.zeros((len(vectors), max(lengths.max(initial=0), 1)), np.float64)
    rows = np.repeat(np.arange(len(vectors)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = np.floor(flat * SCALE)
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both matrices of one width in a type that holds their inner products exactly: doubles below
    2**53, else Python's integers."""
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < 1 << 53:
        return a, b
    whole = np.frompyfunc(int, 1, 1)
    return whole(a), whole(b)


def _long(x) -> int:
    return min(max(int(x), -LONG), LONG - 1)


def _ready(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, vector): distinct rows without a null or a component that is no finite number."""
    c = F.col("vector")
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
            .where(F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))))
    return rows.distinct()


def _blocks(df: DataFrame, n: int, seed: str):
    """Even block of a row by its id."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(n)).cast("int")


def _tiles(anchors: DataFrame, rows: DataFrame, a_blocks: int, r_blocks: int, same: bool, k: int) -> DataFrame:
    """(anchor, window, positive, id, score): the first k of each window in each block of candidates."""
    env = rows.sparkSession.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))

    def work(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if len(ours) and len(theirs):
            side = lambda t: matrix(t.column("vector").combine_chunks())
            queries, rows_ = exact(side(ours), side(theirs))
            others = theirs.column("id").to_numpy(), theirs.column("label").to_numpy(), rows_
            lists = None if same else Lists(*others)
            own: dict[int, Lists] = {}  # of each label
            ids, labels = ours.column("id").to_pylist(), ours.column("label").to_pylist()
            wanted = ours.column("positives").to_pylist()
            for q, anchor, label, positives in zip(queries, ids, labels, wanted, strict=True):
                # low * s <= 100 * x <= high * s, in integers
                bounds = None if same else [(-(-LOW * p["score"] // 100), HIGH * p["score"] // 100) for p in positives]
                windows = Windows(anchor, label, same, bounds, k)
                if same:
                    if label not in own:
                        own[label] = Lists(*(x[others[1] == label] for x in others))
                    lists = own[label]
                for number, found, scores in windows.first(lists, *lists.scores(q, windows)):
                    p = positives[number] if positives else {"id": 0, "score": 0}
                    for column, values in zip(out, ([anchor] * len(found), [p["id"]] * len(found), [p["score"]] * len(found),
                                                    found.tolist(), [_long(s) for s in scores]), strict=True):
                        column.extend(values)
        return pa.table(dict(zip(("anchor", "positive", "positive_score", "id", "score"),
                                 (pa.array(c, pa.int64()) for c in out), strict=True)))

    left = anchors.withColumn("a", _blocks(anchors, a_blocks, "anchor")).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(r_blocks - 1))))
    right = rows.withColumn("r", _blocks(rows, r_blocks, "row")).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(a_blocks - 1))))
    return (left.groupBy("a", "r").cogroup(right.groupBy("a", "r"))
            .applyInArrow(work, "anchor long, positive long, positive_score long, id long, score long"))


def hard_negatives(vectors: DataFrame, anchors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row of
    `anchors`, a part of `vectors`.

    Components become floor(256 * x); a score is the integer inner product with the anchor, higher
    first, ties by smaller id. Positives are the first rows of the anchor's label with another id.
    Negatives of a positive are the first rows of another label with 30 to 90 percent of its score.
    Rows with a null id, label or vector, or a component that is null or not finite, take no part.
    Equal rows count once; vectors of different length are compared as if filled with zeros. Scores
    are exact within 64 bits; one beyond counts as the nearest 64-bit number."""
    rows = keep(_ready(vectors, id_col, vector_col, label_col), "vectors")
    asked = keep(_ready(anchors, id_col, vector_col, label_col), "anchors")
    a_blocks, r_blocks = (max(1, -(-df.count() // size)) for df, size in ((asked, ANCHOR_BLOCK), (rows, BLOCK)))
    none = F.expr("CAST(array() AS array<struct<id: bigint, score: bigint>>)")
    near = _tiles(asked.withColumn("positives", none), rows, a_blocks, r_blocks, True, positives)
    order = [F.col("score").desc(), F.col("id")]
    near = (near.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(order)))
            .where(F.col("rank") <= positives).groupBy("anchor")  # a handful of rows each
            .agg(F.sort_array(F.collect_list(F.struct("id", "score"))).alias("positives")))
    asked = keep(asked.join(near.withColumnRenamed("anchor", "id"), "id"), "with-positives")
    far = _tiles(asked, rows, a_blocks, r_blocks, False, negatives)
    best = Window.partitionBy("anchor", "positive").orderBy(order)
    return (far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
                    F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
