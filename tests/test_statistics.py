"""Quantiles, outliers, clusters, names, correlation."""

import re

import numpy as np
import pytest

from clientela.operators import cluster, profile, quantile, rfm


@pytest.mark.parametrize("small", [10**5, 5])
def test_quantiles_of_any_group_size(spark, monkeypatch, small):
    """Also with brackets from the sketch, on a column where one value fills a third of the rows."""
    monkeypatch.setattr(quantile, "SMALL", small)
    rng = np.random.default_rng(1)
    n = 60_000
    data = {"u": rng.normal(size=n), "s": np.where(np.arange(n) % 3 == 0, 7.0, rng.integers(0, 50, n)),
            "c": np.full(n, 2.5)}
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in zip(*data.values())], list(data))
    ps = (0.0, 0.01, 0.25, 0.5, 0.75, 1.0)
    got = {(r.columna, r.p): r.valor for r in quantile.column_quantiles(df, list(data), ps).collect()}
    for name, values in data.items():
        for p in ps:
            assert got[name, p] == pytest.approx(np.quantile(values, p), abs=1e-12)


def test_quantiles_by_key_with_nulls(make):
    df = make([("a", 1.0), ("a", 2.0), ("a", None), ("b", 5.0), (None, 9.0)], "g string, valor double")
    got = {(r.g, r.p): (r.n, r.valor) for r in quantile.exact_quantiles(df, ["g"], (0.25, 0.5)).collect()}
    assert got == {("a", 0.25): (2, 1.25), ("a", 0.5): (2, 1.5), ("b", 0.25): (1, 5.0), ("b", 0.5): (1, 5.0)}


def test_describe(make):
    df = make([("a", 1), ("a", 3), ("b", 2), (None, 9)], "g string, x int")
    rows = {r.g: r for r in profile.describe(df, ["x"], by="g").collect()}
    assert set(rows) == {"a", "b"}
    assert (rows["a"]["count"], rows["a"]["mean"], rows["a"]["q50"]) == (2, 2.0, 2.0)
    assert rows["a"]["std"] == pytest.approx(np.std([1, 3], ddof=1)) and rows["b"]["std"] is None


def test_describe_all(make):
    df = make([("a", 1), ("b", 2), ("b", 3), ("a", 4), (None, 5)], "g string, x int")
    rows = {r.columna: r for r in profile.describe_all(df, ["x"], ["g"]).collect()}
    assert (rows["g"]["count"], rows["g"]["unique"], rows["g"]["top"], rows["g"]["freq"]) == (4, 2, "a", 2)
    assert rows["x"]["mean"] == 3.0 and rows["x"]["top"] is None


def test_iqr_keeps_bounds_and_constant_columns(make):
    # Quartiles 2 and 4: the bounds are -1 and 7.
    df = make([(1, 5), (2, 5), (3, 5), (4, 5), (7, 5)], "a int, b int")
    assert rfm.iqr_filter(df, ["a", "b"]).count() == 5
    df = make([(1, 5), (2, 5), (3, 5), (4, 5), (8, 5)], "a int, b int")
    assert rfm.iqr_filter(df, ["a", "b"]).count() == 4


def test_rfm_edges(make):
    df = make([("a", "2024-01-01 00:01:00", 1.005), ("a", None, 2.0), ("b", "2024-01-02 00:00:00", None),
               (None, "2024-01-02 00:00:00", 5.0), ("c", "2024-01-01 00:00:00", 1.0)],
              "mail string, fecha timestamp_ntz, total_actualizado double")
    rows = {r.mail: tuple(r)[1:] for r in rfm.rfm(df).collect()}
    assert rows == {"a": (3.005, 1, 0), "b": (0.0, 1, 0), "c": (1.0, 1, 1)}


def means(make, rows):
    return make(rows, "rfm_cluster int, ValorMonetario double, Recencia double")


def names(frame, rule="v1"):
    return {r.rfm_cluster: r.rfm for r in cluster.name_clusters(frame, rule).collect()}


def test_names(make):
    plain = means(make, [(0, 5, 30), (1, 9, 2), (2, 1, 90)])
    assert names(plain) == names(plain, "v2") == {0: "en peligro", 1: "fidelizado", 2: "perdido"}
    tie = means(make, [(0, 9, 30), (1, 9, 20), (2, 1, 90)])
    assert names(tie) == {2: "fidelizado", 0: "perdido", 1: "en peligro"}
    equal_recency = means(make, [(0, 9, 3), (1, 1, 20), (2, 2, 20)])
    assert names(equal_recency) == {0: "fidelizado", 1: "en peligro", 2: "perdido"}
    same = means(make, [(0, 9, 90), (1, 1, 20), (2, 2, 30)])
    assert names(same) == {0: "fidelizado", 2: "perdido", 1: "en peligro"}
    assert names(same, "v2") == {0: "perdido", 1: "en peligro", 2: None}


def test_standardize(make):
    df = make([(1, 4), (3, 4)], "a int, b int")
    assert [(r.a_z, r.b_z) for r in cluster.standardize(df, ["a", "b"]).orderBy("a").collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def blobs(spark):
    rng = np.random.default_rng(2)
    rows = [(f"m{i}", float(rng.normal(c * 10, 1)), float(rng.normal(c * -5, 1)))
            for i, c in enumerate([0, 1, 2] * 60)]
    return spark.createDataFrame(rows, "mail string, ValorMonetario double, y double")


def cost(rows, cols):
    total = 0.0
    for g in {r["rfm_cluster"] for r in rows}:
        pts = np.array([[r[c] for c in cols] for r in rows if r["rfm_cluster"] == g])
        total += ((pts - pts.mean(axis=0)) ** 2).sum()
    return total


def test_lloyd_cost_falls_and_finds_the_groups(spark):
    df, cols = blobs(spark), ["ValorMonetario", "y"]
    costs = [cost(cluster.kmeans_lloyd(df, cols, iters=i).collect(), cols) for i in (0, 1, 5)]
    assert costs[0] >= costs[1] >= costs[2]
    library = cluster.kmeans(df, cols, n_init=3, max_iter=20).collect()
    assert cost(library, cols) == pytest.approx(costs[2])


def test_starts_move_together(spark):
    """Ten starts in common rounds end where each would by itself; the best of them is taken."""
    df, cols = blobs(spark), ["ValorMonetario", "y"]
    points = cluster.weighted_points(df.unionByName(df), cols, "mail").cache()
    assert {r.w for r in points.select("w").distinct().collect()} == {2}
    starts = cluster.hash_seeds(points, 3, 42, 10)
    assert starts == cluster.hash_seeds(points, 3, 42, 10) and all(len({tuple(c) for c in s}) == 3 for s in starts)
    together = cluster.move_centroids(points, starts, 300)
    alone = [cluster.move_centroids(points, [s], 300)[0] for s in starts]
    assert [c for _, c in together] == [c for _, c in alone]
    assert [c for c, _ in together] == pytest.approx([c for c, _ in alone])
    best = cost(cluster.kmeans(df, cols).collect(), cols)
    assert 2 * best == pytest.approx(min(c for c, _ in together))
    points.unpersist()


def test_a_round_is_compiled_however_many_starts(spark):
    """No array of all starts is built per point, and joining and adding run as compiled code."""
    points = spark.range(50).selectExpr("double(id) AS x0", "double(id % 7) AS x1", "1L AS w", "id AS f0", "id % 7 AS f1")
    starts = {s: [[float(s), 0.0], [float(s + 9), 3.0], [40.0, 6.0]] for s in range(40)}
    found = cluster.round_sums(points, starts)
    plan = found._jdf.queryExecution().executedPlan()
    assert "Generate" not in plan.toString()
    found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"\*\(\d+\) BroadcastNestedLoopJoin", text)
    rows = [(x, x % 7) for x in range(50)]
    for s in (0, 39):
        near = [min(range(3), key=lambda i: ((x - starts[s][i][0]) ** 2 + (y - starts[s][i][1]) ** 2, i)) for x, y in rows]
        want = {i: (near.count(i), sum(x for (x, _), n in zip(rows, near) if n == i)) for i in set(near)}
        assert {r.i: (r.w, r.f0) for r in found.where(f"s = {s}").collect()} == want


def test_starts_of_different_length(spark):
    points = spark.range(9).selectExpr("double(id) AS x0", "1L AS w", "id AS f0")
    got = cluster.round_sums(points, {0: [[0.0], [8.0], [4.0]], 1: [[2.0]], 5: [[1.0], [1.0]]}).collect()
    assert {(r.s, r.i): (r.w, r.f0) for r in got} == {(0, 0): (3, 3), (0, 1): (3, 21), (0, 2): (3, 12), (1, 0): (9, 36), (5, 0): (9, 36)}


@pytest.mark.parametrize("factor", [1e-9, 1e13, 1e30])
def test_clusters_do_not_depend_on_the_unit(spark, factor):
    df, cols = blobs(spark), ["ValorMonetario", "y"]
    scaled = df.select("mail", *[(df[c] * factor).alias(c) for c in cols])
    tol = 1e-9 * max(factor, 1)
    labels = lambda t: {r.mail: r.rfm_cluster for r in t.collect()}
    assert labels(cluster.kmeans_lloyd(scaled, cols, tol=tol)) == labels(cluster.kmeans_lloyd(df, cols))
    assert labels(cluster.kmeans(scaled, cols, n_init=2, tol=tol)) == labels(cluster.kmeans(df, cols, n_init=2))


def test_seeds_are_different_points(make):
    rows = [(f"c{i}", 1.0, float(i % 4)) for i in range(40)] + [("z", 9.0, 0.0)]
    df = make(rows, "mail string, ValorMonetario double, y double")
    cols = ["ValorMonetario", "y"]
    seeds = cluster.rank_seeds(df, cols, 3, "ValorMonetario", "mail")
    assert len({tuple(x) for x in seeds}) == 3
    assert len({r.rfm_cluster for r in cluster.kmeans_lloyd(df, cols, k=3).collect()}) == 3
    with pytest.raises(ValueError):
        cluster.kmeans_lloyd(make(rows[:2], "mail string, ValorMonetario double, y double"), cols, k=3)


def test_nothing_stays_cached(spark, make):
    from clientela.operators import profile
    df = make([(i % 3, float(i)) for i in range(50)], "g int, x double")
    profile.describe(df, ["x"], by="g").collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_assign_tie_goes_to_the_lowest(make):
    df = make([(1.0,), (4.0,)], "x double")
    cents = make([(1, 0.0), (0, 2.0)], "cluster int, x double")
    assert [r.rfm_cluster for r in cluster.kmeans_assign(df, ["x"], cents).orderBy("x").collect()] == [0, 0]
    got = df.select(cluster.nearest(["x"], [[2.0], [0.0]])).collect()
    assert [r[0] for r in got] == [0, 0]


# Shares of ten products and three correlations of the published matrix.
SHARES = (.1466, .0709, .0876, .0378, .1955, .0908, .0947, .1305, .0952, .0504)
PUBLISHED = {(0, 1): -0.11448294896650756, (4, 7): -0.19099391073924013, (3, 9): -0.04563858592757394}


def test_correlation_of_one_product_per_customer(spark):
    n, start, rows = 10_000, 0, []
    for i, share in enumerate(SHARES):
        count = round(share * n)
        rows += [(start + j, f"p{i}") for j in range(count)]
        start += count
    df = spark.createDataFrame(rows, "mail long, titulo string")
    got = {(r.a, r.b): r.corr for r in profile.onehot_correlation(df, "mail", "titulo").collect()}
    assert len(got) == 100 and got["p3", "p3"] == 1.0
    for (i, j), value in PUBLISHED.items():
        assert got[f"p{i}", f"p{j}"] == pytest.approx(value, abs=2e-4) == got[f"p{j}", f"p{i}"]


def test_correlation_of_several_products_and_rare_ones(make):
    rows = [(1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, "a"), (4, "b"), (5, "z"), (6, "b")]
    df = make(rows, "mail int, titulo string")
    got = {(r.a, r.b): r.corr for r in profile.onehot_correlation(df, "mail", "titulo", k=2).collect()}
    want = np.corrcoef([1, 1, 0, 1, 0], [1, 0, 1, 1, 1])[0, 1]
    assert got["a", "b"] == pytest.approx(want) and set(got) == {(x, y) for x in "ab" for y in "ab"}
    few = profile.onehot_correlation(df, "mail", "titulo", k=10).collect()
    assert len(few) == 9


def test_matrix_round_trip(make):
    rows = {("x", "x", 1.0), ("x", "y", 0.5), ("y", "x", 0.5), ("y", "y", 1.0)}
    wide = profile.long_to_wide(make(sorted(rows), "a string, b string, corr double"), ["x", "y"])
    assert {tuple(r) for r in profile.matrix_to_long(wide, "a").collect()} == rows
    bare = make([(0, 1.0, 0.5), (1, 0.5, 1.0)], "fila int, x double, y double")
    assert {tuple(r) for r in profile.matrix_to_long(bare).collect()} == rows


def test_histogram_covers_all_rows(make):
    df = make([("g", float(i)) for i in range(10)] + [("h", 9.0), (None, 1.0)], "s string, x double")
    rows = profile.distribution_profile(df, "x", "s", bins=3).collect()
    assert sum(r.n for r in rows) == 11 and {r.bin for r in rows if r.s == "h"} == {2}


def test_density_is_the_kernels_over_all_rows(spark):
    """Close to the sum of kernels at every value, of total 1 within the range, and defined on odd groups."""
    from clientela.operators.profile import density_profile
    rng = np.random.default_rng(4)
    values = {"a": rng.normal(0, 1, 4000), "b": rng.normal(3, 0.5, 500)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs] + [("one", 1.0), ("flat", 2.0), ("flat", 2.0), (None, 1.0), ("a", None)]
    got = density_profile(spark.createDataFrame(rows, "g string, v double"), "v", "g").collect()
    assert {r.g for r in got} == {"a", "b"} and len(got) == 128
    for label, vs in values.items():
        curve = sorted((r.x, r.densidad) for r in got if r.g == label)
        h = vs.std(ddof=1) * len(vs) ** -0.2
        for x, d in curve:
            want = np.exp(-((x - vs) / h) ** 2 / 2).sum() / (len(vs) * h * np.sqrt(2 * np.pi))
            assert d == pytest.approx(want, abs=0.01)
        assert np.trapezoid([d for _, d in curve], [x for x, _ in curve]) == pytest.approx(1, abs=0.02)
    same = spark.createDataFrame([("a", 1.0)] * 5, "g string, v double")
    assert density_profile(same, "v", "g").count() == 0 == density_profile(same.limit(0), "v", "g").count()
