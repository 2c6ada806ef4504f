"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes; a chunk ends where the upper bits of the hash are zero. The hash
sees the last 32 bytes only, so an insertion moves the chunk bounds near it and no others. Chunks
are deduplicated by a 128-bit digest; runs of chunks that stand elsewhere already are extended to
both sides by the characters that they share with the text that holds them, and are passages then."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientela.llm.repeats import runs
from clientela.llm.store import free_name, keep, mapped, renamed
from clientela.llm.textbytes import Piece, slices

SEEN = 32        # bytes that the hash depends on
CUT_BITS = 5     # a bound every 32 bytes on average, after
LEAST, MOST = 16, 240  # bytes in a chunk; text that recurs with a short period has no bounds of its own
RUN_WORDS = 20   # words that begin in a passage
REACH = 511      # most characters by which a run is extended to a side; a power of two less one
BLANK = r"\x20\x09-\x0D"

GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Sum over j < SEEN of GEAR[byte j places back] << j, at each byte; by doubling spans."""
    h, span = GEAR[data], 1
    while span < SEEN:
        shifted = np.zeros_like(h)
        shifted[span:] = h[:-span] << np.uint32(span)
        h, span = h + shifted, span * 2
    return h


def bounds(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each chunk. A text's last chunk ends with it."""
    data = piece.bytes
    cuts = np.flatnonzero(gear(data) >> np.uint32(32 - CUT_BITS) == 0) + 1
    cuts = cuts[:-1] if len(cuts) and cuts[-1] == len(data) else cuts
    cuts = cuts[(data[cuts] & 0xC0) != 0x80]  # between characters
    splits = np.searchsorted(cuts, piece.offsets).tolist()
    cuts, firsts, ends = cuts.tolist(), [], []
    offsets = piece.offsets.tolist()
    for row in range(piece.rows):
        first, stop = offsets[row], offsets[row + 1]
        sees = first + SEEN  # before, the hash holds bytes of the text before
        for cut in [*cuts[splits[row]:splits[row + 1]], stop]:
            while cut - first > MOST:
                end = first + MOST
                while data[end] & 0xC0 == 0x80:
                    end -= 1
                firsts.append(first)
                ends.append(end)
                first = end
            if first < cut == stop or cut >= sees and LEAST <= cut - first and cut < stop:
                firsts.append(first)
                ends.append(cut)
                first = cut
    return np.array(firsts, np.int64), np.array(ends, np.int64)


def _first_at(rows: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Least index at which the same row holds the same digest."""
    order = np.lexsort((np.arange(len(rows)), h2, h1, rows))
    new = np.ones(len(rows), bool)
    new[1:] = (np.diff(rows[order]) != 0) | (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
    out = np.zeros(len(rows), np.int64)
    out[order] = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(rows) else order
    return out


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        piece = Piece(part)
        firsts, ends = bounds(piece)
        rows = piece.row_of(firsts)
        h1, h2 = (piece.hashes(firsts, ends, kind) for kind in (0, 1))
        points = np.concatenate([[0], np.cumsum((piece.bytes & 0xC0) != 0x80)])
        words = np.zeros(len(piece.bytes) + 1, np.int64)
        words[piece.words()[0] + 1] = 1
        words = np.cumsum(words)
        base = points[piece.offsets[rows]]
        first = _first_at(rows, h1, h2)
        start = (points[firsts] - base).astype(np.int32)
        yield pa.record_batch({
            "id": part.column(0).take(pa.array(rows)), "h1": h1.view(np.int64), "h2": h2.view(np.int64),
            "start": start, "end": (points[ends] - base).astype(np.int32),
            "words": (words[ends] - words[firsts]).astype(np.int32), "first": start[first]})


def _repeated(chunks: DataFrame) -> DataFrame:
    """Chunks that occurred before, with the least id that holds them (`source`) and where (`at`)."""
    once = chunks.where("first = start")
    shared = (once.groupBy("h1", "h2").agg(F.min("id").alias("source"), F.min_by("start", "id").alias("at"), F.max("id").alias("last"))
              .where("source < last").drop("last"))
    across = once.join(shared, ["h1", "h2"]).where("source < id")
    within = chunks.where("first < start").withColumn("source", F.col("id")).withColumn("at", F.col("first"))
    return across.unionByName(within).drop("h1", "h2", "first")


def _common(a: str, b: str, side: str) -> Column:
    """Number of characters in which two texts agree, from the left or the right on."""
    steps = ", ".join(str(1 << k) for k in reversed(range(REACH.bit_length())))
    return F.expr(f"aggregate(array({steps}), 0, (n, s) -> IF(length({a}) >= n + s AND length({b}) >= n + s "
                  f"AND {side}({a}, n + s) = {side}({b}, n + s), n + s, n))")


def _extended(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Runs with what stands around them and around their first and last chunks' sources alike."""
    head, tail = (F.struct(*c, "source", "at") for c in (["end"], ["start"]))
    found = keep(runs(found, ("words",), (F.min_by(head, "start").alias("head"), F.max_by(tail, "end").alias("tail"))), "runs")
    sides = {"head": ("start", "head.end"), "tail": ("tail.start", "end")}
    own = {k: [F.col("id"), F.col(a).alias("start"), F.col(b).alias("end"), F.lit(k).alias("side")] for k, (a, b) in sides.items()}
    theirs = {k: [F.col(f"{k}.source").alias("id"), F.col(f"{k}.at").alias("start"),
                  (F.col(f"{k}.at") + F.col(b) - F.col(a)).alias("end"), F.lit(k).alias("side")] for k, (a, b) in sides.items()}
    asked = found.select(own["head"])
    for columns in (own["tail"], theirs["head"], theirs["tail"]):
        asked = asked.union(found.select(columns))
    text = F.when(F.col("side") == "head", F.concat(  # a blank stands for the bounds of the text
        F.lit(" "), F.col("text")).substr(F.greatest(F.lit(1), F.col("start") + 1 - REACH), F.least(F.lit(REACH + 1), F.col("start") + 1))
    ).otherwise(F.col("text").substr(F.col("end"), F.lit(REACH + 1)))
    chunk = F.xxhash64(F.col("text").substr(F.col("start") + 1, F.col("end") - F.col("start")))
    excerpts = docs.join(asked.distinct(), "id").select("id", "start", "end", "side", chunk.alias("chunk"), text.alias("around"))
    excerpts = keep(excerpts.distinct(), "excerpts")

    for k, (a, b) in sides.items():
        part = excerpts.where(F.col("side") == k)
        named = lambda p: part.select(*[F.col(c).alias(f"{p}_{c}") for c in ("id", "start", "end", "chunk", "around")])  # noqa: B023, E731
        both = (found.join(named("own"), (F.col("id") == F.col("own_id")) & (F.col(a) == F.col("own_start")) & (F.col(b) == F.col("own_end")))
                .join(named("their"), (F.col(f"{k}.source") == F.col("their_id")) & (F.col(f"{k}.at") == F.col("their_start"))
                      & (F.col(f"{k}.at") + F.col(b) - F.col(a) == F.col("their_end")) & (F.col("own_chunk") == F.col("their_chunk"))))
        # the outermost character of a head is the one before what may be shared, the first of a tail is the chunk's last
        bare = "substr({0}, 2)"
        both = both.withColumn("n", _common(bare.format("own_around"), bare.format("their_around"), "right" if k == "head" else "left"))
        best = both.groupBy("id", "start", "end").agg(F.max("n").alias(f"n_{k}"), F.max_by("own_around", "n").alias(f"text_{k}"))
        found = found.join(best, ["id", "start", "end"], "left")
    order = Window.partitionBy("id").orderBy("start")
    gap_before = F.col("start") - F.lag("end").over(order)
    gap_after = F.lead("start").over(order) - F.col("end")
    before = F.coalesce(gap_before - F.least(F.lag("n_tail").over(order), gap_before), F.lit(REACH))
    found = found.fillna(0, ["n_head", "n_tail"]).fillna("", ["text_head", "text_tail"])
    found = found.select("id", "start", "end", "head.source", "units", "words", "text_head", "text_tail",
                         F.least("n_head", before).alias("n_head"), F.least("n_tail", F.coalesce(gap_after, F.lit(REACH))).alias("n_tail"))
    begun = lambda t: F.regexp_count(t, F.lit(f"(?<=[{BLANK}])[^{BLANK}]"))
    return found.select(
        "id", (F.col("start") - F.col("n_head")).alias("start"), (F.col("end") + F.col("n_tail")).alias("end"), "source", "units",
        (F.col("words") + begun(F.expr("right(text_head, n_head + 1)")) + begun(F.expr("left(text_tail, n_tail + 1)"))).alias("words"))





def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      run_words: int = RUN_WORDS) -> DataFrame:
    """Passages that stand earlier, in a text of smaller id or in the same text: id, start, end
    (code points, end exclusive), n_chunks, n_words, source_id (the least id that holds the first
    chunk). A passage is a longest run of repeated chunks, with the up to REACH characters on each
    side that the source shares, in which `run_words` words begin.

    Null and
    empty texts have no chunk. Rows without an id are left out, since nothing orders them. Rows
    that repeat an id are one document: equal texts do not remove each other."""
    docs = renamed(docs, id_col, text_col).where("id IS NOT NULL")
    kind = docs.schema["id"].dataType.simpleString()
    chunks = mapped(docs, _chunks, f"id {kind}, h1 long, h2 long, start int, end int, words int, first int")
    found = _extended(docs, _repeated(chunks).distinct())
    found = runs(found.withColumnRenamed("units", "n"), ("words", "n")).where(F.col("words") >= run_words)
    return found.select(
        F.col("id").alias(id_col), "start", "end", F.col("n").alias("n_chunks"),
        F.col("words").alias("n_words"), F.col("source").alias("source_id"))


def delete_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the spans of `found` (as repeated_passages returns it). All columns stay, whatever
    their names."""
    held = free_name(docs, "__gone")
    gone = found.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(held))
    text = F.col(f"`{text_col}`")
    kept = F.aggregate(
        F.col(held), F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda acc, g: F.struct(F.concat(acc["text"], F.substring(text, acc["at"] + 1, g["start"] - acc["at"])).alias("text"),
                                g["end"].alias("at")),
        lambda acc: F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.length(text))))
    return docs.join(gone, id_col, "left").withColumn(
        text_col, F.when(F.col(held).isNull(), text).otherwise(kept)).select([F.col(f"`{c}`") for c in docs.columns])
