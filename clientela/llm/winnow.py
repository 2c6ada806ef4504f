"""Repeated runs of lines by winnowing.

Every line that holds more than white space is hashed. Of each WINDOW consecutive line hashes the
least (the last among equals) is a fingerprint, so two texts that share WINDOW lines in a row are
certain to share a fingerprint. Only windows around fingerprints that several texts hold are
compared. A matched window is extended to both sides as long as the next window matches too; the
later copy of the run goes. Shorter runs count where they hold many words: single lines and pairs
of lines are windows of their own then."""

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.llm.repeats import repeated, runs
from clientela.llm.store import free_name, keep, mapped, renamed
from clientela.llm.textbytes import SPACE, Piece, grams, slices

WINDOW = 3       # lines; the shortest run that is found whatever it holds
LONG_WORDS = 50  # a shorter run is found if it holds more words


def solid_lines(piece: Piece) -> tuple[np.ndarray, ...]:
    """Row, number within its text, first byte and end of each line that isn't blank."""
    firsts, ends = piece.lines()
    rows = piece.line_rows
    before = np.concatenate([[0], np.cumsum(~SPACE[piece.bytes])])
    number = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    solid = before[ends] > before[firsts]
    return rows[solid], number[solid], firsts[solid], ends[solid]


def _seen_before(rows: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether the same row holds the same digest at a smaller index."""
    order = np.lexsort((np.arange(len(rows)), h2, h1, rows))
    same = np.zeros(len(rows), bool)
    same[1:] = (np.diff(rows[order]) == 0) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
    out = np.zeros(len(rows), bool)
    out[order] = same
    return out


def _windows(long_words: int | None) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of WINDOW lines; and, unless `long_words` is None, shorter ones of more words."""
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            piece = Piece(part)
            rows, number, firsts, ends = solid_lines(piece)
            lines = [piece.hashes(firsts, ends, kind) for kind in (0, 1)]
            words = np.zeros(len(piece.bytes) + 1, np.int64)
            words[piece.words()[0] + 1] = 1
            words = np.cumsum(words)
            words = np.concatenate([[0], np.cumsum(words[ends] - words[firsts])])
            found = []
            for n in range(WINDOW if long_words is None else 1, WINDOW + 1):
                h1, at = grams(lines[0], rows, n)
                h2, _ = grams(lines[1], rows, n)
                if n < WINDOW:
                    held = words[at + n] - words[at] > long_words
                    h1, h2, at = h1[held], h2[held], at[held]
                least = lines[0][at] if len(at) else h1
                for i in range(1, n):
                    least = np.minimum(least, lines[0][at + i])
                found.append((at, at + n - 1, least, h1, h2))
            at, last, least, h1, h2 = map(np.concatenate, zip(*found, strict=True))
            yield pa.record_batch({
                "id": part.column(0).take(pa.array(rows[at])),
                "fingerprint": least.view(np.int64), "h1": h1.view(np.int64), "h2": h2.view(np.int64),
                "start": number[at].astype(np.int32), "end": number[last].astype(np.int32),
                "again": _seen_before(rows[at], h1, h2)})
    return work


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  long_words: int | None = None) -> DataFrame:
    """Runs of at least WINDOW lines, or of more than `long_words` words if given, that stand earlier, in a text of smaller id or higher up in
    the same text: id, first_line, last_line (from 0), n_windows (matched, of all lengths), source_id
    (the least id that holds the first window, the longest that begins there; or the text's own id if it
    holds it higher up).

    Lines are split at line feeds and compared whole; blank lines neither count nor break a run.
    Null and empty texts have no run. Rows without an id are left out, since nothing orders them.
    Rows that repeat an id are one document: equal texts do not remove each other."""
    docs = renamed(docs, id_col, text_col).where("id IS NOT NULL")
    kind = docs.schema["id"].dataType.simpleString()
    windows = mapped(docs, _windows(long_words), f"id {kind}, fingerprint long, h1 long, h2 long, start int, end int, again boolean")
    windows = keep(windows, "windows")
    joined = (windows.groupBy("fingerprint").agg(F.min("id").alias("low"), F.max("id").alias("high"))
              .where("low < high").select("fingerprint"))
    near = windows.where("NOT again").join(joined, "fingerprint", "left_semi")
    found = repeated(near.unionByName(windows.where("again")).drop("fingerprint")).distinct()
    return runs(found).select(
        F.col("id").alias(id_col), F.col("start").alias("first_line"), F.col("end").alias("last_line"),
        F.col("units").alias("n_windows"), F.col("source").alias("source_id"))


def delete_runs(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the lines of `found` (as repeated_runs returns it). All columns stay, whatever
    their names; a text without a run stays as it is, byte for byte. A document of which no word is left goes."""
    held = free_name(docs, "__gone")
    gone = keep(found.groupBy(id_col).agg(F.collect_list(F.struct("first_line", "last_line")).alias(held)), "gone")
    text = F.col(f"`{text_col}`")
    stays = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.exists(
        F.col(held), lambda g: (i >= g["first_line"]) & (i <= g["last_line"])))
    left = F.when(F.col(held).isNull(), text).otherwise(F.array_join(stays, "\n"))
    return (docs.join(gone, id_col, "left").withColumn(text_col, left)
            .where(F.col(held).isNull() | text.rlike(r"[^\x20\x09-\x0D]"))
            .select([F.col(f"`{c}`") for c in docs.columns]))
