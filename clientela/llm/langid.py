"""Language identification by cross-parsing.

For each language, a suffix automaton of labelled text accepts exactly the strings that occur in
it. A text is parsed from left to right into longest strings of that kind; the language whose text
needs the fewest phrases, in bits, wins. All segments of a batch are parsed together."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import LOWER, Piece, slices

DOCUMENTS = 64       # labelled documents of each language at most that are learned from
DOC_BYTES = 3_000    # of each of them
STRETCHES = 6        # evenly spread over a longer one, that make up its part
TEXT_BYTES = 60_000  # of each language
SEGMENT = 512        # bytes that are parsed at a stretch; a phrase ends at the end of a segment
UNKNOWN = "und"

LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = True
LETTER[0x80:] = True


def letters_only(data: np.ndarray) -> np.ndarray:
    """Which bytes to keep so that a run of others becomes one gap."""
    solid = LETTER[LOWER[data]]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    return keep


class Automaton:
    """Suffix automaton of a string of codes, as a table: state and code to state, 0 for none."""

    def __init__(self, codes: list[int], n_codes: int):
        table, link, length, last = [[0] * n_codes], [-1], [0], 0
        for c in codes:
            new = len(table)
            table.append([0] * n_codes)
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and not table[p][c]:
                table[p][c] = new
                p = link[p]
            if p >= 0:
                q = table[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(table)
                    table.append(table[q][:])
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and table[p][c] == q:
                        table[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.table = np.array(table, np.int32)


class Model:
    """Automata of languages over one alphabet: gap, a-z, and the other bytes that the labelled
    texts hold. Any other byte is known to no language."""

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        data = {name: np.frombuffer(text, np.uint8) for name, text in texts.items()}
        seen = np.unique(np.concatenate([LOWER[x] for x in data.values()])) if data else np.zeros(0, np.uint8)
        seen = seen[LETTER[seen]]
        self.code = np.zeros(256, np.uint8)          # 0: gap
        self.code[LETTER] = len(seen) + 1            # in no text
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.code = self.code[LOWER]
        self.automata, self.bits = [], []
        for name in self.languages:
            codes = self.code[data[name][letters_only(data[name])]]
            self.automata.append(Automaton(codes.tolist(), len(seen) + 2).table)
            self.bits.append(np.log2(len(codes) + 2))

    def predict(self, piece: Piece) -> tuple[list[str], np.ndarray]:
        n = piece.rows
        lettered = _lettered(piece)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n)
        keep = letters_only(piece.bytes)
        keep[piece.offsets[:-1][np.diff(piece.offsets) > 0]] = True
        codes = self.code[piece.bytes[keep]]
        bounds = np.concatenate([[0], np.cumsum(keep)])[piece.offsets]
        sizes = np.diff(bounds)
        parts = -(-sizes // SEGMENT)
        rows = np.repeat(np.arange(n), parts)
        number = np.arange(len(rows)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = bounds[rows] + number * SEGMENT
        lengths = np.minimum(SEGMENT, bounds[rows + 1] - starts)
        cost = np.column_stack([
            np.bincount(rows, weights=_phrases(table, codes, starts, lengths), minlength=n) * bits / np.maximum(sizes, 1)
            for table, bits in zip(self.automata, self.bits, strict=True)])
        best = cost.argmin(1)  # of equals, the first by name
        share = np.exp(-(cost - cost.min(1, keepdims=True)) * np.log(2))
        score = np.where(lettered, 1 / share.sum(1), 0.0)
        return [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)], score


def _phrases(table: np.ndarray, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of phrases of each segment."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    width, flat, root = table.shape[1], table.ravel(), table[0]
    state, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for t in range(int(lengths.max(initial=0))):
        alive = int(np.searchsorted(-lengths, -t, "left"))
        now = state[:alive]
        c = codes[starts[:alive] + t]
        to = flat[now * width + c]
        lost = to == 0
        count[:alive] += lost & (now != 0)
        fresh = root[c]
        count[:alive] += lost & (fresh == 0)  # a code that the text lacks is a phrase
        state[:alive] = np.where(lost, fresh, to)
    count += state != 0
    out = np.zeros(len(starts), np.int64)
    out[order] = count
    return out


def _lettered(piece: Piece) -> np.ndarray:
    """Whether each row holds a letter."""
    plain = np.flatnonzero((piece.bytes | 0x20 >= ord("a")) & (piece.bytes | 0x20 <= ord("z")))
    found = piece.per_row(plain) > 0
    for row in np.flatnonzero(~found & (np.diff(piece.offsets) > 0)):
        text = piece.bytes[piece.offsets[row]:piece.offsets[row + 1]].tobytes().decode("utf-8", "replace")
        found[row] = any(c.isalpha() for c in text)
    return found


def learn(docs: DataFrame, use: Column, lang_col: str = "lang",
          id_col: str = "doc_id", text_col: str = "text") -> dict[str, bytes]:
    """Labelled text of each language: of up to DOCUMENTS documents for which `use` holds and the language
    is known, DOC_BYTES each and TEXT_BYTES in all. A longer document gives STRETCHES of equal length,
    from its first to its last character. The documents are chosen by id and language alone; only theirs come to
    the driver, one text (the least) where an id repeats."""
    known = docs.where(use).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang")).where(
        "lang IS NOT NULL AND id IS NOT NULL")
    slot = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(DOCUMENTS))
    chosen = known.groupBy("lang", slot.alias("slot")).agg(F.min("id").alias("id")).select("id", "lang")
    size = DOC_BYTES // STRETCHES
    spread = ", ' ', ".join(f"substring(text, CAST(floor({i}D * (length(text) - {size}) / {STRETCHES - 1}) AS INT) + 1, {size})"
                            for i in range(STRETCHES))
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    parts = texts.join(F.broadcast(chosen), ["id", "lang"]).where("text <> ''").selectExpr(
        "lang", "id", f"IF(length(text) <= {DOC_BYTES}, text, concat({spread})) AS text")
    rows = parts.groupBy("lang", "id").agg(F.min("text").alias("text")).orderBy("lang", "id").collect()
    out: dict[str, bytes] = {}
    for r in rows:
        out[r["lang"]] = out.get(r["lang"], b"") + r["text"].encode("utf-8", "replace")[:DOC_BYTES] + b" "
    return {name: text[:TEXT_BYTES] for name, text in out.items()}


_LOADED: dict[int, Model] = {}


def _model(texts: dict[str, bytes]) -> Model:
    """One model per Python worker and set of texts."""
    key = hash(tuple(sorted(texts.items())))
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Model(texts)
    return _LOADED[key]


def identify(docs: DataFrame, texts: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each row, from the whole text. lang_pred is `und` with score 0 for
    a text that is null or has no letter; on a tie the first language by name wins. The score is
    the winner's share of 2 ** -(bits per byte) over all languages."""
    rows = renamed(docs, id_col, text_col)
    shared = rows.sparkSession.sparkContext.broadcast(texts)

    def work(batches) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for part in slices(batches):
            names, score = model.predict(Piece(part))
            yield pa.record_batch({"id": part.column(0), "lang_pred": pa.array(names, pa.string()), "score": score})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)
