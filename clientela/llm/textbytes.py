"""Vectorised work on the UTF-8 bytes of many texts at once, for use inside Arrow tasks.

Texts of one Arrow batch lie one behind another in a single byte array. A piece is a run of rows
of bounded size (a longer single text is a piece of its own), so memory does not grow with the
partition. Words are maximal runs of bytes outside 0x20 and 0x09-0x0D."""

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
PIECE_ROWS = 500
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_MIX_A, _MIX_B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED05)  # odd, 5 modulo 8: powers stay apart in their low bits
_BYTE_CODES = [np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64) for seed in (11, 12)]
_LOWER_CODES = [codes[LOWER] for codes in _BYTE_CODES]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX_A
    x ^= x >> np.uint64(33)
    x *= _MIX_B
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of a base and of its inverse modulo 2**64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, PIECE_BYTES)
            with np.errstate(over="ignore"):
                for name, factor in (("up", self.base), ("down", self.inverse)):
                    factors = np.full(n, factor, np.uint64)
                    factors[0] = 1
                    setattr(self, name, np.cumprod(factors, dtype=np.uint64))


@cache
def powers(kind: int) -> Powers:
    return Powers(_BASES[kind])


def slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of at most PIECE_BYTES of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = Piece(batch, column).offsets[1:]
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = int(np.searchsorted(ends, base + PIECE_BYTES, "right"))
            stop = min(max(stop, at + 1), at + PIECE_ROWS, batch.num_rows)
            yield batch.slice(at, stop - at)
            at = stop


class Piece:
    """Bytes of a column of texts; a null text counts as empty. `offsets` bounds each row."""

    def __init__(self, batch: pa.RecordBatch, column: str = "text"):
        texts = batch.column(batch.schema.get_field_index(column))
        if not pa.types.is_string(texts.type) and not pa.types.is_large_string(texts.type):
            texts = texts.cast(pa.string())
        kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
        if texts.null_count:
            texts = texts.fill_null("")
        _, bounds, data = texts.buffers()
        n = len(texts)
        offsets = np.frombuffer(bounds, kind, n + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.bytes = raw[offsets[0]:offsets[-1]]
        self.offsets = offsets - offsets[0]
        self.rows = n

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        """Row of each byte position; positions ascend."""
        return np.repeat(np.arange(self.rows), self.per_row(positions))

    def per_row(self, positions: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(positions, self.offsets))

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each word."""
        solid = ~SPACE[self.bytes]
        edge = np.zeros(len(solid) + 1, bool)
        edge[self.offsets] = True
        first = solid & edge[:-1]
        first[1:] |= solid[1:] & ~solid[:-1]
        last = solid & edge[1:]
        last[:-1] |= solid[:-1] & ~solid[1:]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """First byte and end of each line; an empty text is one empty line."""
        breaks = np.flatnonzero(self.bytes == 10)
        firsts = np.concatenate([self.offsets[:-1], breaks + 1])
        ends = np.concatenate([self.offsets[1:], breaks])
        owner = np.concatenate([np.arange(self.rows),
                                np.searchsorted(self.offsets, breaks, "right") - 1])
        order = np.lexsort((firsts, owner))
        firsts, owner = firsts[order], owner[order]
        order = np.lexsort((ends, np.concatenate([np.arange(self.rows), np.searchsorted(
            self.offsets, breaks, "right") - 1])))
        self.line_rows = owner
        return firsts, ends[order]

    def hashes(self, firsts: np.ndarray, ends: np.ndarray, kind: int = 0, lower: bool = False) -> np.ndarray:
        """64-bit hash of each byte span by its content and length. Two kinds are independent."""
        with np.errstate(over="ignore"):
            p = powers(kind)
            p.grow(len(self.bytes) + 1)
            codes = (_LOWER_CODES if lower else _BYTE_CODES)[kind]
            sums = np.zeros(len(self.bytes) + 1, np.uint64)
            np.cumsum(codes[self.bytes] * p.up[:len(self.bytes)], out=sums[1:])
            found = (sums[ends] - sums[firsts]) * p.down[firsts]
            return mix(found + (ends - firsts).astype(np.uint64) * _MIX_B)


def grams(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each n consecutive items that share a row, and the index of the first item."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) - n + 1, np.uint64)
        for i in range(n):
            total = (total + hashes[i:len(hashes) - n + 1 + i]) * _MIX_A
    at = np.flatnonzero(rows[:len(rows) - n + 1] == rows[n - 1:])
    return mix(total[at] + np.uint64(n)), at


def shingle_sets(piece: Piece, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, as (row, hash) ascending: n consecutive words with
    A-Z lower-cased, the whole sequence where a row has fewer words, nothing without words."""
    firsts, ends = piece.words()
    rows = piece.row_of(firsts)
    words = piece.hashes(firsts, ends, lower=True)
    found, at = grams(words, rows, n)
    found_rows = rows[at]
    counts = np.bincount(rows, minlength=piece.rows)
    for k in range(1, n):
        if (counts == k).any():
            few = (counts == k)[rows]
            more, more_at = grams(words[few], rows[few], k)
            found, found_rows = np.concatenate([found, more]), np.concatenate([found_rows, rows[few][more_at]])
    order = np.lexsort((found, found_rows))
    found, found_rows = found[order], found_rows[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (found_rows[1:] != found_rows[:-1])
    return found_rows[new], found[new]
