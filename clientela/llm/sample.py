"""Bounded samples of labelled rows to fit models on."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_CHARS = 20_000  # longest text that is learned from; all texts are scored whole


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
             id_col: str = "doc_id", text_col: str = "text") -> list[tuple[str, int]]:
    """(text, label) of up to `per_class` documents of each label 0 and 1 among labels for which
    `learn` holds, the first by a hash of the id. Where labels of an id differ, 1 counts. Only
    these ids, 2 * per_class at most, and their texts come to the driver."""
    known = (labels.where(learn).where(F.col(label).isin(0, 1)).where(F.col(id_col).isNotNull())
             .groupBy(id_col).agg(F.max(label).cast("int").alias("label")))
    rank = F.xxhash64(F.lit(label), F.col(id_col).cast("string"))
    chosen = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).orderBy(rank, id_col).limit(per_class)
        chosen = some if chosen is None else chosen.union(some)
    texts = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("text"))
    rows = (texts.join(F.broadcast(chosen), id_col).where(F.length("text") <= SAMPLE_CHARS)
            .orderBy(id_col, "text").limit(2 * per_class).collect())
    return [(r["text"], r["label"]) for r in rows]


class Adam:
    """Adam steps on a list of arrays, in place."""

    def __init__(self, values: Sequence, rate: float):
        import numpy as np
        self.np, self.values, self.rate, self.turn = np, values, rate, 0
        self.mean = [np.zeros_like(v) for v in values]
        self.square = [np.zeros_like(v) for v in values]

    def step(self, gradients: Sequence) -> None:
        self.turn += 1
        for v, g, m, s in zip(self.values, gradients, self.mean, self.square, strict=True):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= self.rate * (m / (1 - 0.9 ** self.turn)) / (self.np.sqrt(s / (1 - 0.99 ** self.turn)) + 1e-8)
