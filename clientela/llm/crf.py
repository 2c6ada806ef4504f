"""Quality rules: a linear-chain conditional random field labels each line as content or
boilerplate; Viterbi decoding, and the share of words in content lines decides.

Labels are known of whole documents only. Labels of lines are latent: a document's label makes its
lines likelier to have it, by LEAN, and the field learns from what is then expected of each line and
each pair of neighbours. So a line of a bad document that looks like those of good ones may count as
content, and the other way round."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientela.llm.features import N_FEATURES, shapes, tiled_lines
from clientela.llm.sample import Adam, labelled
from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import SPACE, Piece, grams, slices

# Fixed values of the rules.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
LEAST_WORDS, REPEAT_PERCENT = 50, 50

CONTENT_SHARE = 0.5  # of words in content lines, at least
PER_CLASS = 400      # labelled documents of each class whose lines are learned from
STEPS, RATE, DECAY = 150, 0.05, 1e-3
LEAN = 2.0           # log-odds of a line having its document's label, before it is looked at


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


class Chains:
    """Sequences of different lengths, longest first, stepped through together: at step t the
    first `alive[t]` of them have a line."""

    def __init__(self, rows: np.ndarray, n: int):
        lengths = np.bincount(rows, minlength=n)
        self.starts = np.searchsorted(rows, np.arange(n))
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.alive = [int(np.searchsorted(-self.lengths, -t, "left")) for t in range(int(lengths.max(initial=0)))]

    def lines(self, t: int) -> np.ndarray:
        """Index of line t of each sequence that has one."""
        return self.starts[self.order[:self.alive[t]]] + t


class Model:
    """Label 1 is content. Scores of a line are linear in its features; `move` scores labels of
    neighbouring lines."""

    def __init__(self):
        self.center, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.weights, self.bias, self.move = np.zeros((N_FEATURES, 2)), np.zeros(2), np.zeros((2, 2))

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return (x - self.center) / self.scale @ self.weights + self.bias

    def viterbi(self, rows: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        """Most likely label of each line; content on a tie."""
        scores, chains = self.emissions(x), Chains(rows, n)
        back = np.zeros((len(x), 2), np.int8)
        best = np.zeros((n, 2))
        for t, alive in enumerate(chains.alive):
            at = chains.lines(t)
            if t:
                paths = best[:alive, :, None] + self.move
                back[at] = paths[:, 1] >= paths[:, 0]
                best[:alive] = paths.max(1)
            best[:alive] += scores[at]
        labels = np.zeros(len(x), np.int8)
        now = (best[:, 1] >= best[:, 0]).astype(np.int8)
        for t in range(len(chains.alive) - 1, -1, -1):
            at = chains.lines(t)
            labels[at] = now[:len(at)]
            now[:len(at)] = back[at, labels[at]]
        return labels

    def expected(self, rows: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each label of each line, and the expected number of neighbours of each pair
        of labels, by forward and backward sums."""
        chains = Chains(rows, n)
        ahead, behind = np.zeros((len(rows), 2)), np.zeros((len(rows), 2))
        for t in range(len(chains.alive)):
            at = chains.lines(t)
            ahead[at] = scores[at] + (_logsum(ahead[at - 1][:, :, None] + self.move, 1) if t else 0)
        moves = np.zeros((2, 2))
        total = np.zeros(n)
        total[rows] = _logsum(ahead, 1)  # the last line of a row is written last
        for t in range(len(chains.alive) - 1, 0, -1):
            at = chains.lines(t)
            onward = self.move + (scores[at] + behind[at])[:, None, :]
            behind[at - 1] = _logsum(onward, 2)
            moves += np.exp(ahead[at - 1][:, :, None] + onward - total[rows[at]][:, None, None]).sum(0)
        return np.exp(ahead + behind - total[rows][:, None]), moves

    def _pull(self, x: np.ndarray, p: np.ndarray, moves: np.ndarray) -> list[np.ndarray]:
        z = (x - self.center) / self.scale
        return [z.T @ p / len(x) + DECAY * self.weights, p.sum(0) / len(x), moves / len(x)]

    def gradients(self, rows: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> list[np.ndarray]:
        """Of the negative log likelihood per line of known labels."""
        p, moves = self.expected(rows, self.emissions(x), n)
        p[np.arange(len(y)), y] -= 1
        same = rows[:-1] == rows[1:]
        np.subtract.at(moves, (y[:-1][same], y[1:][same]), 1)
        return self._pull(x, p, moves)

    def latent_gradients(self, rows: np.ndarray, x: np.ndarray, lean: np.ndarray, n: int) -> list[np.ndarray]:
        """Of the negative log per line of what `lean`, added to the scores of each line, is expected to be
        worth: the sums of all paths with it, over those without."""
        scores = self.emissions(x)
        free, moves = self.expected(rows, scores, n)
        drawn, drawn_moves = self.expected(rows, scores + lean, n)
        found = self._pull(x, free - drawn, moves - drawn_moves)
        found[2] += DECAY * self.move
        return found


def fit(sample: list[tuple[str, int]]) -> Model:
    """Fit on labelled documents, whose lines have labels of their own that are not known. Without rows
    everything is content."""
    model = Model()
    if not sample:
        return model
    rows, x, seen = [], [], 0
    for part in slices([pa.record_batch({"text": pa.array([t for t, _ in sample], pa.string())})]):
        piece = Piece(part)
        owner, firsts, ends = tiled_lines(piece)
        rows.append(owner + seen)
        x.append(shapes(piece, firsts, ends))
        seen += part.num_rows
    rows, x = np.concatenate(rows), np.concatenate(x)
    lean = np.zeros((len(rows), 2))
    lean[np.arange(len(rows)), np.array([label for _, label in sample])[rows]] = LEAN
    model.center, model.scale = x.mean(0), np.maximum(x.std(0), 0.02)
    adam = Adam([model.weights, model.bias, model.move], RATE)
    for _ in range(STEPS):
        adam.step(model.latent_gradients(rows, x, lean, seen))
    return model


def _repeats(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item, whether its row holds an equal one, and whether an earlier one."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    same = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    later, any_ = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = same
    any_[order[1:]] = same
    any_[order[:-1]] |= same
    return any_, later


def counts(piece: Piece) -> dict[str, np.ndarray]:
    """The base counts of each row."""
    n, data = piece.rows, piece.bytes
    owner = np.repeat(np.arange(n), np.diff(piece.offsets))
    firsts, ends = piece.words()
    rows = piece.row_of(firsts)
    points = (data & 0xC0) != 0x80
    n_words = np.bincount(rows, minlength=n)

    line_firsts, line_ends = piece.lines()
    line_rows = piece.line_rows
    worded = np.concatenate([[0], np.cumsum(~SPACE[data])])
    solid = worded[line_ends] > worded[line_firsts]
    _, later = _repeats(piece.hashes(line_firsts, line_ends)[solid], line_rows[solid])

    threes, at = grams(piece.hashes(firsts, ends), rows, 3)
    twice, _ = _repeats(threes, rows[at])
    covered = np.zeros(len(firsts), bool)
    for i in range(3):
        covered[at[twice] + i] = True
    return {
        "n_words": n_words,
        "word_chars": np.bincount(owner, weights=points & ~SPACE[data], minlength=n).astype(np.int64),
        "n_symbols": np.bincount(owner, weights=SYMBOLS[data], minlength=n).astype(np.int64),
        "n_dup_lines": np.bincount(line_rows[solid][later], minlength=n),
        "n_repeat_words": np.bincount(rows[covered], minlength=n)}


def judge(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, content_share, kept.

    base_failed: fewer than 50 words, or over half of the words in 3-word windows that recur in
    the text. content_share: words in lines that the field labels content, of all words (0 without
    words). kept: not base_failed and a content_share of at least CONTENT_SHARE. A null text
    counts as empty. Lines, words and windows are compared by 64-bit hashes."""
    rows = renamed(docs, id_col, text_col)

    def work(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            piece = Piece(part)
            found = counts(piece)
            line_rows, firsts, ends = tiled_lines(piece)
            labels = model.viterbi(line_rows, shapes(piece, firsts, ends), piece.rows)
            word_firsts, _ = piece.words()
            line = np.searchsorted(firsts, word_firsts, "right") - 1
            content = np.bincount(piece.row_of(word_firsts)[labels[line] == 1], minlength=piece.rows)
            n = found["n_words"]
            failed = (n < LEAST_WORDS) | (100 * found["n_repeat_words"] > REPEAT_PERCENT * n)
            share = content / np.maximum(n, 1)
            yield pa.record_batch({"id": part.column(0), **found, "base_failed": failed, "content_share": share,
                                   "kept": ~failed & (share >= CONTENT_SHARE)})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                  "n_repeat_words long, base_failed boolean, content_share double, kept boolean").withColumnRenamed("id", id_col)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality",
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on labelled documents; see sample.labelled for the bound."""
    return fit(labelled(docs, labels, label, F.lit(True), PER_CLASS, id_col, text_col))
