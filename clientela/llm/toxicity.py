"""Toxicity by embeddings of subwords under a linear softmax.

A word is the mean of the vectors of its character n-grams, a bag of words the mean of its words;
vectors and the softmax over (clean, toxic) are trained together. Words that were never seen share
n-grams with words that were. A document is scored by its bags, each weighed by how toxic it looks,
so a few words in a long text count."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from clientela.llm.sample import Adam, labelled
from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import LOWER, SPACE, Piece, mix, slices

GRAMS = (3, 4, 5)    # bytes, the bounds of a word included
BUCKETS = 1 << 16
WIDTH = 8            # of vectors
BAG_WORDS = 1
PER_CLASS = 1500     # labelled documents of each class that are learned from
STEPS, RATE, DECAY = 40, 0.1, 1e-4
LEAST_TEXTS = 5      # learned from, that hold an n-gram that gets a vector
FOLDS = 3            # of the learned documents, whose logits the scale is fitted on
DECISION = 0.7       # score from which a document counts as toxic


def bags_of(rows: np.ndarray) -> np.ndarray:
    """Bag of each word: BAG_WORDS in a row of one text."""
    number = np.arange(len(rows)) - np.searchsorted(rows, rows, "left")
    return np.cumsum(number % BAG_WORDS == 0) - 1


class Words:
    """Words of a piece, lower-cased, each between spaces; and the buckets of their n-grams."""

    def __init__(self, piece: Piece):
        firsts, ends = piece.words()
        self.rows = piece.row_of(firsts)
        self.n = len(firsts)
        solid = ~SPACE[piece.bytes]
        lengths = ends - firsts
        self.starts = np.cumsum(np.concatenate([[0], lengths[:-1] + 1])) + 1 if self.n else firsts
        text = np.full(int(lengths.sum()) + self.n + 1, 0x20, np.uint8)
        text[np.arange(int(lengths.sum())) + np.repeat(np.arange(self.n), lengths) + 1] = LOWER[piece.bytes[solid]]
        self.text, self.gaps = text, np.concatenate([[0], np.cumsum(text == 0x20)])

    def buckets(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of the n-gram at each byte and whether it stays within one word and its bounds."""
        count = len(self.text) - n + 1
        if count <= 0 or not self.n:
            return np.zeros(0, np.int64), np.zeros(0, bool)
        h = np.zeros(count, np.uint64)
        for i in range(n):
            h = h << np.uint64(8) | self.text[i:i + count]
        inside = self.gaps[n - 1:n - 1 + count] == self.gaps[1:1 + count]
        return (mix(h + np.uint64(n << 56)) >> np.uint64(48)).astype(np.int64), inside

    def word_of(self, positions: np.ndarray) -> np.ndarray:
        """Word that an n-gram starting there belongs to; a space belongs to the word behind it."""
        return self.gaps[positions + 1] - 1

    def means(self, values: np.ndarray) -> np.ndarray:
        """Mean value of each word's n-grams, for one value per bucket."""
        total, count = np.zeros(self.n), np.zeros(self.n)
        for n in GRAMS:
            bucket, inside = self.buckets(n)
            if len(bucket):
                at = np.flatnonzero(inside)
                word = self.word_of(at)
                total += np.bincount(word, weights=values[bucket[at]], minlength=self.n)
                count += np.bincount(word, minlength=self.n)
        return total / np.maximum(count, 1)


def _weighed(logits: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean of the logits of each row, weighed by their exponentials; and the weights. -inf for a
    row without any."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, rows, logits)
    e = np.exp(logits - top[rows])
    share = e / np.bincount(rows, weights=e, minlength=n)[rows]
    out = np.bincount(rows, weights=share * logits, minlength=n)
    out[np.isinf(top)] = -np.inf
    return out, share


class Model:
    """Value of each bucket for the toxic class, offsets and the scale of document logits."""

    def __init__(self):
        self.values, self.bias, self.slope, self.shift = np.zeros(BUCKETS), 0.0, 1.0, -2.0

    def logits(self, piece: Piece) -> np.ndarray:
        words = Words(piece)
        if not words.n:
            return np.full(piece.rows, -np.inf)
        bags = bags_of(words.rows)
        sizes = np.bincount(bags)
        logits = np.bincount(bags, weights=words.means(self.values)) / sizes + self.bias
        rows = words.rows[np.concatenate([[0], np.cumsum(sizes)[:-1]])]
        return _weighed(logits, rows, piece.rows)[0]

    def score(self, piece: Piece) -> np.ndarray:
        z = self.logits(piece)
        out = np.zeros(len(z))
        some = np.isfinite(z)
        out[some] = 1 / (1 + np.exp(-np.clip(self.slope * z[some] + self.shift, -40, 40)))
        return out


def _scaled(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of labels on logits, by Newton steps with a little ridge. Both classes weigh alike,
    so the scale does not follow from how many of each are sampled."""
    if not len(y) or y.min() == y.max():
        return 1.0, 0.0
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    loss = lambda a, b: (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (a * z + b))).sum() + 5e-3 * a * a
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = weight * p * (1 - p) + 1e-9
        g = np.array([(weight * (p - y) * z).sum() + 1e-2 * a, (weight * (p - y)).sum()])
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        while loss(a - step[0], b - step[1]) > loss(a, b) and np.abs(step).max() > 1e-6:
            step /= 2  # a whole step may go past the least loss
        a, b = a - step[0], b - step[1]
    return float(max(a, 1e-3)), float(b)


def fit(sample: list[tuple[str, int]]) -> Model:
    """Vectors, softmax and bag weights together on document labels; the scale of the score on logits
    that each part of the documents gets from a model of the others. Without labelled rows of both
    classes nothing looks toxic."""
    y = np.array([label for _, label in sample], float)
    if not len(y) or y.min() == y.max():
        return Model()
    texts = pa.array([t for t, _ in sample], pa.string())
    part = np.where(y == 1, np.cumsum(y == 1), np.cumsum(y != 1)) % FOLDS
    z = np.full(len(y), -np.inf)
    for k in range(FOLDS):
        others = _learned(texts.filter(pa.array(part != k)), y[part != k])
        z[part == k] = np.concatenate([others.logits(Piece(p)) for p in slices(
            [pa.record_batch({"text": texts.filter(pa.array(part == k))})])] or [[]])
    model = _learned(texts, y)
    some = np.isfinite(z)
    model.slope, model.shift = _scaled(z[some], y[some])
    return model


def _learned(texts: pa.Array, known: np.ndarray) -> Model:
    """Vectors and softmax by full-batch Adam, not scaled yet."""
    model = Model()
    if not len(known) or known.min() == known.max():
        return model
    # distinct words, and the word and text of each occurrence
    hashes, owner_rows, spelled, n = [], [], {}, 0
    for part in slices([pa.record_batch({"text": texts})]):
        words = Words(Piece(part))
        if words.n:
            ends = np.concatenate([words.starts[1:] - 1, [len(words.text) - 1]])
            found = Piece(pa.record_batch({"text": [words.text.tobytes().decode()]})).hashes(words.starts, ends)
            for i, h in zip(*np.unique(found, return_index=True)[::-1], strict=True):
                spelled.setdefault(int(h), words.text[words.starts[i]:ends[i]].tobytes())
            hashes.append(found)
            owner_rows.append(words.rows + n)
        n += part.num_rows
    if not hashes:
        return model
    order, word = np.unique(np.concatenate(hashes), return_inverse=True)
    text_rows = np.concatenate(owner_rows)
    own = Words(Piece(pa.record_batch({"text": [b" ".join(spelled[int(h)] for h in order).decode()]})))
    entries, owners = [], []
    for size in GRAMS:
        bucket, inside = own.buckets(size)
        at = np.flatnonzero(inside)
        entries.append(bucket[at])
        owners.append(own.word_of(at))
    entries, owners = np.concatenate(entries), np.concatenate(owners)
    part = 1 / np.maximum(np.bincount(owners, minlength=own.n), 1)[owners]
    bags = bags_of(text_rows)
    sizes = np.bincount(bags)
    rows = text_rows[np.concatenate([[0], np.cumsum(sizes)[:-1]])]
    weight = np.where(known == 1, 0.5 / known.mean(), 0.5 / (1 - known.mean())) / n

    g = np.random.default_rng(9)
    vectors, softmax, bias = g.normal(0, 0.1, (BUCKETS, WIDTH)), g.normal(0, 0.1, (WIDTH, 2)), np.zeros(2)
    adam = Adam([vectors, softmax, bias], RATE)
    pairs = np.unique(text_rows * own.n + word)  # (text, word), once each
    texts_of = np.bincount(pairs % own.n, minlength=own.n)
    used = np.bincount(entries, weights=texts_of[owners], minlength=BUCKETS) >= LEAST_TEXTS
    vectors[~used] = 0
    for _ in range(STEPS):
        # a step needs values per direction only: linear maps are applied to vectors, then summed
        toxic = softmax[:, 1] - softmax[:, 0]
        values = vectors @ toxic
        word_value = np.bincount(owners, weights=part * values[entries], minlength=own.n)
        logits = np.bincount(bags, weights=word_value[word]) / sizes + bias[1] - bias[0]
        z, share = _weighed(logits, rows, n)
        z = np.where(np.isfinite(z), z, 0)
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - known) * weight
        by_bag = error[rows] * share
        by_word = np.bincount(word, weights=(by_bag / sizes)[bags], minlength=own.n)
        by_bucket = np.bincount(entries, weights=part * by_word[owners], minlength=BUCKETS)
        pull = vectors.T @ by_bucket
        adam.step([np.where(used[:, None], by_bucket[:, None] * toxic + DECAY * vectors, 0),
                   np.column_stack([-pull, pull]) + 1e-6 * softmax, np.array([-by_bag.sum(), by_bag.sum()])])
    model.values = vectors @ (softmax[:, 1] - softmax[:, 0])
    model.bias = float(bias[1] - bias[0])
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row: how likely the whole text is toxic. Texts without words score 0."""
    rows = renamed(docs, id_col, text_col)

    def work(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield pa.record_batch({"id": part.column(0), "score": model.score(Piece(part))})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, score double").withColumnRenamed("id", id_col)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic",
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labels for which `learn` holds; see sample.labelled for the bound."""
    return fit(labelled(docs, labels, label, learn, PER_CLASS, id_col, text_col))
