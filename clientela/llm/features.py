"""Shape of spans of text: shares of kinds of bytes, words and repetition."""

import numpy as np

from clientela.llm.textbytes import SPACE, Piece

#: A class of its own for each mark that junk is made of; the rest by kind.
_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\n", b" \t\r\x0b\x0c",
            b".,;:?'\"()-", b"!", b"#", b"$", b"%", b"&", b"*", b"|", b"<>{}[]\\/=_~^+`@", bytes(range(128, 256)))
CLASS = np.full(256, len(_CLASSES), np.int64)
for _i, _set in enumerate(_CLASSES):
    CLASS[np.frombuffer(_set, np.uint8)] = _i
N_CLASSES = len(_CLASSES) + 1
N_FEATURES = N_CLASSES + 5


def passages(piece: Piece, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of passages of n words that tile each text; an empty text is one
    empty passage."""
    firsts, _ = piece.words()
    rows = piece.row_of(firsts)
    number = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    inner = (number % n_words == 0) & (number > 0)
    owner = np.concatenate([np.arange(piece.rows), rows[inner]])
    start = np.concatenate([piece.offsets[:-1], firsts[inner]])
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    return owner, start, np.concatenate([start[1:], piece.offsets[-1:]])


def tiled_lines(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte and end of each line, its line feed included."""
    firsts, _ = piece.lines()
    return piece.line_rows, firsts, np.concatenate([firsts[1:], piece.offsets[-1:]])


def shapes(piece: Piece, firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Features (spans, N_FEATURES) of spans that tile the bytes of the piece."""
    n = len(firsts)
    owner = np.repeat(np.arange(n), ends - firsts)
    counts = np.bincount(owner * N_CLASSES + CLASS[piece.bytes], minlength=n * N_CLASSES).reshape(n, N_CLASSES)
    word_firsts, word_ends = piece.words()
    span = owner[word_firsts]
    words = np.bincount(span, minlength=n)
    short = np.bincount(span, weights=word_ends - word_firsts <= 3, minlength=n)
    hashes = piece.hashes(word_firsts, word_ends, lower=True)
    order = np.lexsort((hashes, span))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (span[order][1:] != span[order][:-1])
    distinct = np.bincount(span[order][new], minlength=n)
    solid = np.bincount(owner, weights=~SPACE[piece.bytes], minlength=n)
    some = np.maximum(words, 1)
    return np.column_stack([
        np.sqrt(counts / np.maximum(ends - firsts, 1)[:, None]),
        np.log1p(words) / 4, solid / some / 8, short / some, distinct / some, words == 0])
