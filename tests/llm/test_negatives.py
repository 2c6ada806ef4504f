"""Hard negatives against brute force, and the stopping rule."""

import math
import random

import numpy as np
import pytest

from clientela.llm import negatives


def brute(rows, anchors):
    """Rows (id, vector, label), with Python's integers."""
    ready = sorted({(i, label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
                    if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v)})
    out = set()
    for a, label, q in (r for r in ready if r[0] in anchors):
        dot = lambda v, q=q: sum(x * y for x, y in zip(q, v))  # noqa: E731  (shorter ones count as filled with zeros)
        scored = sorted((-dot(v), i, other) for i, other, v in ready)
        for neg, p, _ in [s for s in scored if s[2] == label and s[1] != a][:5]:
            fits = [s for s in scored if s[2] != label and 30 * -neg <= 100 * -s[0] <= 90 * -neg][:10]
            out |= {(a, p, rank, i, -neg, -s) for rank, (s, i, _) in enumerate(fits, 1)}
    return out


def mined(spark, rows, anchors):
    table = spark.createDataFrame([(i, v, label, 5, "p") for i, v, label in rows],
                                  "vec_id long, embedding array<float>, label int, id int, positives string")
    got = negatives.hard_negatives(table, table.where(table.vec_id.isin(list(anchors))))
    found = [tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(found) == len(set(found))
    return set(found)


def vectors(n, width, seed=0, labels=4):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(width)] for _ in range(labels)]
    for i in range(n):
        label = r.randrange(labels)
        yield i, [float(np.float32(0.2 * c + r.gauss(0, 0.15))) for c in centre[label]], label


@pytest.mark.parametrize(("n", "width", "block"), [(300, 8, 50), (400, 3, 4096), (60, 40, 7)])
def test_equal_to_brute_force(spark, monkeypatch, n, width, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 10)
    monkeypatch.setattr(negatives, "FIRST_DEPTH", 2)
    rows = list(vectors(n, width))
    anchors = set(range(0, n, 9))
    want = brute(rows, anchors)
    assert len(want) > 100 and mined(spark, rows, anchors) == want


def test_ties_nulls_repeats_and_odd_components(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.5], 1) for i in range(0, 40, 2)] + [(i, [0.5, 0.25], 2) for i in range(1, 60, 2)]
    rows += [(100, None, 1), (101, [nan, 1.0], 1), (102, [inf, 1.0], 2), (103, [1.0, None], 2), (104, [1.0, 1.0], None), (None, [1.0, 1.0], 2)]
    rows += [(0, [1.0, 0.5], 1), (1, [0.5, 0.25], 2), (105, [], 2), (106, [], 1), (107, [1.0], 1), (108, [0.25, 0.5, 9.0], 2), (109, [-1.0, -1.0], 1)]
    rows += [(110, [0.0, 0.0], 3), (111, [0.0, 0.0], 3), (112, [0.0, 0.0], 4)]
    anchors = {0, 1, 2, 100, 105, 106, 109, 110}
    want = brute(rows, anchors)
    assert {w[0] for w in want} >= {0, 2, 105, 110} and mined(spark, rows, anchors) == want
    assert mined(spark, rows[:0], anchors) == set()


def test_large_components_are_exact(spark):
    r = random.Random(5)
    rows = [(i, [float(np.float32(r.uniform(-1, 1) * 1e6)) for _ in range(4)], i % 2) for i in range(80)]
    want = brute(rows, {0, 1, 2})
    assert max(abs(w[5]) for w in want) > 1 << 53 and mined(spark, rows, {0, 1, 2}) == want
    beyond = mined(spark, [(i, [3e38, float(i)], i % 2) for i in range(20)], {0, 1})
    assert all(abs(w[4]) <= negatives.LONG for w in beyond)


def test_reading_stops_early():
    """Where few dimensions tell rows apart, most rows are never scored."""
    rng = np.random.default_rng(3)
    rows = np.floor(rng.normal(0, 1, (20_000, 4)) ** 3 * 256)
    lists = negatives.Lists(np.arange(20_000), np.zeros(20_000, int), rows)
    window = negatives.Windows(-1, 0, True, None, 5)
    at, found = lists.scores(rows[7], window)
    [(_, ids, scores)] = window.first(lists, at, found)
    order = np.lexsort((np.arange(20_000), -(rows @ rows[7])))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == (rows @ rows[7])[order].tolist()
    assert lists.read < 5000
    low = int((rows @ rows[7]).max()) + 1
    before = lists.read
    lists.scores(rows[7], negatives.Windows(-1, 1, False, [(low * 3, low * 4)], 10))
    assert lists.read - before < 500  # no row can be in the window
