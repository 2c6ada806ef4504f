"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Both token lists are arrays of end offsets. While the ends agree at the current shift of indices,
stretches of tokens are compared at once, each twice as long as the one before; where a stretch
differs its halves tell how far the agreement goes. Tokens that do not end together are walked
one end at a time until both lists end at the same byte, which sets the next shift. Groups are
the tokens between ends that both lists share."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientela.llm import encoders
from clientela.llm.store import keep, mapped, renamed
from clientela.llm.textbytes import slices

SHORT = 8             # ends of a run compared one by one before stretches are
HEAD_ROWS = 1 << 18  # pairs of the highest counts that are sent to every task
GATHERED = 1 << 21   # pairs of documents counted together before they are shuffled


class Groups:
    """Groups of two lists of ends, whose last ends are equal: `runs` (first in A, first in B, length)
    of one-to-one groups, `knots` (from, to in A, from, to in B) of the others."""

    def __init__(self, ends_a: np.ndarray, ends_b: np.ndarray):
        self.ends_a, self.ends_b = ends_a, ends_b
        runs, knots, compared = [], [], 0
        a, b = [*ends_a.tolist(), -1], [*ends_b.tolist(), -2]  # the last entries agree with nothing
        i, j, n = 0, 0, len(ends_a)
        while i < n:
            x, y = a[i], b[j]
            if x == y:  # a run at this shift: probe twice as far each time, then halve
                k, m, near = i + 1, j + 1, i + SHORT
                while k < near and a[k] == b[m]:
                    k += 1
                    m += 1
                if k == near:
                    step = SHORT
                    while a[k:k + step] == b[m:m + step]:
                        k += step
                        m += step
                        step += step
                        compared += 1
                    while step > 1:
                        step >>= 1
                        compared += 1
                        if a[k:k + step] == b[m:m + step]:
                            k += step
                            m += step
                runs.append((i, j, k - i))
            else:  # a knot: go on in the list that is behind, to the next shared end
                k, m = i, j
                while x != y:
                    if x < y:
                        k += 1
                        x = a[k]
                    else:
                        m += 1
                        y = b[m]
                k += 1
                m += 1
                compared += k - i + m - j
                knots.append((i, k, j, m))
            i, j = k, m
        self.compared = compared  # stretches and single ends
        self.runs, self.knots = np.array(runs, np.int64).reshape(-1, 3), np.array(knots, np.int64).reshape(-1, 4)

    @staticmethod
    def _each(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Every index of some stretches."""
        return np.arange(lengths.sum()) + np.repeat(firsts - (np.cumsum(lengths) - lengths), lengths)

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token of A, of B, is the last of its group."""
        out = []
        for side, n in ((0, len(self.ends_a)), (1, len(self.ends_b))):
            last = np.ones(n, bool)
            firsts, stops = self.knots[:, 2 * side], self.knots[:, 2 * side + 1]
            last[self._each(firsts, stops - firsts - 1)] = False
            out.append(last)
        return out[0], out[1]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Indices in A and B of all pairs of tokens whose bytes overlap: each end in a knot closes one."""
        run_a, run_b, length = self.runs.T
        in_a = self._each(self.knots[:, 0], self.knots[:, 1] - self.knots[:, 0])
        in_b = self._each(self.knots[:, 2], self.knots[:, 3] - self.knots[:, 2])
        own_a, own_b = self.ends_a[in_a], self.ends_b[in_b]
        ends = np.union1d(own_a, own_b)
        return (np.concatenate([self._each(run_a, length), in_a[np.searchsorted(own_a, ends)]]),
                np.concatenate([self._each(run_b, length), in_b[np.searchsorted(own_b, ends)]]))


class Aligner:
    """Both tokenizers, and what their ids spell."""

    def __init__(self, bytes_json: str, piece_file: bytes):
        self.a, self.b = encoders.byte_level(bytes_json, plain=True), encoders.piece_model(piece_file)
        self.base = len(self.b.spelled)  # a pair of ids is a * base + b
        self.most = max(len(self.a.spelled), self.base)
        self.written = [b"%d%c" % (i, mark) for mark in b",|;" for i in range(self.most)]

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where the bytes of a side are not those of blank + text."""
        a = [np.frombuffer(x, "<i4") for x in self.a.ids([" " + t if t else "" for t in texts])]
        b = [np.frombuffer(x, "<i4") for x in self.b.ids(texts)]
        none, raw = np.zeros(0, "<i4"), [b" " + t.encode() if t else b"" for t in texts]
        for side, ids in ((self.a, a), (self.b, b)):
            if side.lossless:
                continue
            say = side.spelled.__getitem__
            if b"".join(map(say, np.concatenate(ids).tolist())) != b"".join(raw):
                for k, text in enumerate(raw):
                    if b"".join(map(say, ids[k].tolist())) != text:
                        a[k] = b[k] = none
                        raw[k] = b""
        return a, b

    def digests(self, ids: list[np.ndarray], groups: Groups, counts: list[np.ndarray]) -> list[str]:
        """SHA-256 of the groups of each text as a1,a2|b1;a3|b2: a token and the mark behind it are
        one entry of a table, laid in the order of groups."""
        last = groups.last()
        marked = [ids[0] + np.where(last[0], self.most, 0), ids[1] + np.where(last[1], 2 * self.most, 0)]
        group = [np.cumsum(x) - x for x in last]  # of each token
        size = [np.diff(np.concatenate([[0], np.flatnonzero(x) + 1])) for x in last]
        before = np.concatenate([[0], np.cumsum(size[0] + size[1])])  # tokens of both sides before a group
        first = [np.cumsum(x) - x for x in size]                      # first token of a group in its side
        out = np.empty(len(marked[0]) + len(marked[1]), np.int64)
        place_a = before[group[0]] + np.arange(len(marked[0])) - first[0][group[0]]
        place_b = before[group[1]] + size[0][group[1]] + np.arange(len(marked[1])) - first[1][group[1]]
        out[place_a], out[place_b] = marked[0], marked[1]
        named = list(map(self.written.__getitem__, out.tolist()))
        bounds = np.concatenate([[0], np.cumsum(counts[0] + counts[1])]).tolist()
        return [hashlib.sha256(b"".join(named[s:e])[:-1]).hexdigest() if e > s else ""
                for s, e in zip(bounds[:-1], bounds[1:], strict=True)]

    def piece(self, texts: list[str]) -> dict[str, list]:
        """The columns of `aligned` for some texts; `pairs` are the distinct pairs of ids of a text,
        ascending, and `times` how often each is linked."""
        sides = self.tokens(texts)
        counts = [np.array([len(x) for x in side], np.int64) for side in sides]
        ids = [np.concatenate(side).astype(np.int64) for side in sides]
        groups = Groups(np.cumsum(self.a.widths[ids[0]]), np.cumsum(self.b.widths[ids[1]]))  # texts end together: no group spans two
        text_of = np.repeat(np.arange(len(texts)), counts[0])
        link_a, link_b = groups.links()
        size = len(self.a.spelled) * self.base
        keys, times = np.unique(text_of[link_a] * size + ids[0][link_a] * self.base + ids[1][link_b], return_counts=True)
        rows = np.searchsorted(keys, np.arange(len(texts) + 1) * size)
        keys %= size
        return {"n_a": counts[0].tolist(), "n_b": counts[1].tolist(),
                "n_groups": np.bincount(text_of[groups.last()[0]], minlength=len(texts)).tolist(),
                "n_links": np.bincount(text_of[link_a], minlength=len(texts)).tolist(),
                "groups_sha256": self.digests(ids, groups, counts),
                "pairs": [keys[s:e].astype("<i8").tobytes() for s, e in zip(rows[:-1], rows[1:], strict=True)],
                "times": [times[s:e].astype("<i4").tobytes() for s, e in zip(rows[:-1], rows[1:], strict=True)]}


_LOADED: dict[int, Aligner] = {}


def _loaded(sources) -> Aligner:
    key = hash(sources.value)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Aligner(*sources.value)
    return _LOADED[key]


def aligned(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: row (a number of its own), id, n_a, n_b, n_groups, n_links, groups_sha256,
    pairs and times. A null or empty text, and one that a tokenizer changes, has no tokens."""
    rows = renamed(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    with open(bytes_path, encoding="utf-8") as one, open(pieces_path, "rb") as two:
        sources = docs.sparkSession.sparkContext.broadcast((one.read(), two.read()))

    def work(batches) -> Iterator[pa.RecordBatch]:
        aligner = _loaded(sources)
        for part in slices(batches):
            found = aligner.piece([t or "" for t in part.column(1).to_pylist()])
            kinds = {"groups_sha256": pa.string(), "pairs": pa.binary(), "times": pa.binary()}
            yield pa.record_batch({"row": part.column(2), "id": part.column(0), **{
                k: pa.array(v, kinds.get(k, pa.int64())) for k, v in found.items()}})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                              "groups_sha256 string, pairs binary, times binary")


def pair_counts(found: DataFrame, base: int) -> DataFrame:
    """(pair, n, best): in how many documents a pair of ids is linked, and whether no pair with the
    same A id is in more. Documents are counted together in tasks before anything is shuffled."""
    def work(batches) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            pairs, times = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"pair": pa.array(pairs), "n": pa.array(times.astype(np.int64))})

        for batch in batches:
            for cell in batch.column(0):
                held.append(np.frombuffer(cell.as_buffer(), "<i8"))
                n += len(held[-1])
                if n >= GATHERED:
                    yield counted()
                    held, n = [], 0
        if held:
            yield counted()

    counts = mapped(found.select("pairs"), work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    same = Window.partitionBy(F.expr(f"pair div {base}"))  # as many rows as B has ids, at most
    return counts.withColumn("best", F.col("n") == F.max("n").over(same))


def _head(counts: DataFrame) -> Column:
    """Condition that at most HEAD_ROWS rows meet, those of the highest counts."""
    sizes = {r.size: r.rows for r in counts.groupBy(F.expr("CAST(floor(log2(n)) AS INT)").alias("size"))
             .agg(F.count("*").alias("rows")).collect()}  # 64 rows at most
    least, rows = 63, 0
    for size in sorted(sizes, reverse=True):
        rows += sizes[size]
        if rows > HEAD_ROWS:
            break
        least = size
    return F.expr(f"CAST(floor(log2(n)) AS INT) >= {least}")


def alignment(docs: DataFrame, bytes_path: str, pieces_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is the byte-level tokenizer on blank + text, B the piece model on the text. Two tokens are
    linked where their bytes overlap. The count of a pair of ids is the number of documents that
    hold it linked; `n_best` are the links whose count no pair of the same A id exceeds. A text that
    is null or empty, or that a tokenizer does not give back byte for byte, has no tokens: zeros and
    an empty digest. Each row counts as a document of its own, also where ids repeat or are null.

    The pairs of highest counts, HEAD_ROWS at most, are looked up in the tasks; the others, which
    few documents hold, are joined."""
    from sentencepiece import SentencePieceProcessor
    base = SentencePieceProcessor(model_file=pieces_path).get_piece_size()
    found = keep(aligned(docs, bytes_path, pieces_path, id_col, text_col), "aligned")
    counts = keep(pair_counts(found, base), "pair-counts")
    top = _head(counts)
    rows = counts.where(top).orderBy("pair").toPandas()  # HEAD_ROWS at most
    head = docs.sparkSession.sparkContext.broadcast((rows["pair"].to_numpy(), rows["n"].to_numpy(), rows["best"].to_numpy()))

    def work(batches) -> Iterator[pa.RecordBatch]:
        pairs, counted, best = head.value
        for batch in batches:
            keys = [np.frombuffer(c.as_buffer(), "<i8") for c in batch.column("pairs")]
            times = [np.frombuffer(c.as_buffer(), "<i4") for c in batch.column("times")]
            bounds = np.cumsum([0, *map(len, keys)])
            flat, often = np.concatenate(keys), np.concatenate(times).astype(np.int64)
            at = np.searchsorted(pairs, flat)
            there = at < len(pairs)
            there[there] = pairs[at[there]] == flat[there]
            own = at[there]
            sums = np.zeros((2, len(flat) + 1), np.int64)
            sums[0, 1:][there], sums[1, 1:][there] = often[there] * best[own], often[there] * counted[own]
            sums = np.cumsum(sums, axis=1)[:, bounds]
            left = np.cumsum(np.concatenate([[0], ~there]))[bounds].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in plain), pa.array(np.diff(sums[0])), pa.array(np.diff(sums[1])),
                 pa.ListArray.from_arrays(left, pa.array(flat[~there])), pa.ListArray.from_arrays(left, pa.array(often[~there]))],
                names=[*plain, "head_best", "head_sum", "rest", "rest_times"])

    plain = [c for c in found.columns if c not in ("pairs", "times")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.select(plain).schema.fields)
    scored = keep(mapped(found, work, f"{schema}, head_best long, head_sum long, rest array<long>, rest_times array<long>"), "scored")
    rest = (scored.where("size(rest) > 0").select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("x"))
            .select("row", F.col("x.rest").alias("pair"), F.col("x.rest_times").alias("times")))
    more = (rest.join(counts.where(~top), "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                 F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    total = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return scored.join(more, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", total("head_best", "more_best").alias("n_best"),
        total("head_sum", "more_sum").alias("count_sum"), "groups_sha256")
