"""Quality by attention over passages (multiple-instance learning).

A document is a bag of passages. Each passage is encoded, gated attention learned from document
labels alone weighs the encodings, and the weighted mean is scored."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientela.llm.features import N_FEATURES, passages, shapes
from clientela.llm.sample import Adam, labelled
from clientela.llm.store import mapped, renamed
from clientela.llm.textbytes import Piece, slices

PASSAGE_WORDS = 64
HIDDEN, ATTENTION = 16, 8
PER_CLASS = 1000  # labelled documents of each class that are learned from
STEPS, RATE, DECAY = 300, 0.02, 1e-4
DECISION = 0.3    # score from which a document counts as good


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _pool(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by ascending row."""
    at = np.searchsorted(rows, np.arange(n))
    return np.add.reduceat(values, at, axis=0)


def bags(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Row and features of each passage; every row has one at least."""
    piece = Piece(batch, column)
    rows, firsts, ends = passages(piece, PASSAGE_WORDS)
    return rows, shapes(piece, firsts, ends)


class Model:
    """Encoder (tanh layer), gated attention, linear score."""

    def __init__(self, seed: int = 3):
        g = np.random.default_rng(seed)
        self.center, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.encode, self.offset = g.normal(0, 0.3, (N_FEATURES, HIDDEN)), np.zeros(HIDDEN)
        self.attend, self.gate = g.normal(0, 0.3, (HIDDEN, ATTENTION)), g.normal(0, 0.3, (HIDDEN, ATTENTION))
        self.weigh, self.out, self.bias = g.normal(0, 0.3, ATTENTION), g.normal(0, 0.3, HIDDEN), np.zeros(1)

    def parameters(self) -> list[np.ndarray]:
        return [self.encode, self.offset, self.attend, self.gate, self.weigh, self.out, self.bias]

    def forward(self, rows: np.ndarray, x: np.ndarray, n: int) -> tuple:
        x = (x - self.center) / self.scale
        h = np.tanh(x @ self.encode + self.offset)
        t, s = np.tanh(h @ self.attend), _sigmoid(h @ self.gate)
        e = np.exp(np.clip((t * s) @ self.weigh, -30, 30))
        a = e / _pool(e, rows, n)[rows]
        z = _pool(a[:, None] * h, rows, n)
        return x, h, t, s, a, z, _sigmoid(z @ self.out + self.bias)

    def score(self, rows: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        return self.forward(rows, x, n)[-1]

    def gradients(self, rows: np.ndarray, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        x, h, t, s, a, z, p = self.forward(rows, x, len(y))
        d = (p - y) * weight
        dz = d[:, None] * self.out
        da = (dz[rows] * h).sum(1)
        de = a * (da - _pool(a * da, rows, len(y))[rows])
        dh = a[:, None] * dz[rows]
        dt, ds = de[:, None] * s * self.weigh * (1 - t * t), de[:, None] * t * self.weigh * s * (1 - s)
        dh += dt @ self.attend.T + ds @ self.gate.T
        du = dh * (1 - h * h)
        g = [x.T @ du, du.sum(0), h.T @ dt, h.T @ ds, (t * s).T @ de, z.T @ d, d.sum(keepdims=True)]
        return [b + DECAY * v for b, v in zip(g, self.parameters(), strict=True)]


def fit(sample: list[tuple[str, int]]) -> Model:
    """Full-batch Adam; classes weigh the same. Without any labelled row every score is 0.5, with
    rows of one class only the model leans to it."""
    model = Model()
    if not sample:
        model.out[:] = 0
        return model
    rows, x, seen = [], [], 0
    for part in slices([pa.record_batch({"text": pa.array([t for t, _ in sample], pa.string())})]):
        owner, found = bags(part)
        rows.append(owner + seen)
        x.append(found)
        seen += part.num_rows
    rows, x = np.concatenate(rows), np.concatenate(x)
    y = np.array([label for _, label in sample], float)
    model.center, model.scale = x.mean(0), np.maximum(x.std(0), 0.02)
    share = np.clip(y.mean(), 1e-9, 1 - 1e-9)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share)) / len(y)
    adam = Adam(model.parameters(), RATE)
    for _ in range(STEPS):
        adam.step(model.gradients(rows, x, y, weight))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of each row: probability of label 1, from the whole text alone. Null and empty
    texts are one empty passage and get the score of that."""
    rows = renamed(docs, id_col, text_col)

    def work(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            owner, x = bags(part)
            yield pa.record_batch({"id": part.column(0), "score": model.score(owner, x, part.num_rows)})

    kind = rows.schema["id"].dataType.simpleString()
    return mapped(rows, work, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """Rows of `docs`, all columns, whose whole text scores `least` or more."""

    def work(batches) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text_col):
            owner, x = bags(part, text_col)
            yield part.filter(pa.array(model.score(owner, x, part.num_rows) >= least))

    return mapped(docs, work, docs.schema)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality",
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labels for which `learn` holds; see sample.labelled for the bound."""
    return fit(labelled(docs, labels, label, learn, PER_CLASS, id_col, text_col))
