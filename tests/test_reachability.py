import numpy as np

from playstats.operators.reachability import mutual_reachability_forest

COLS = "track_id long, x double, y double"


def plain_tree(points, k):
    """Edges (a, b, weight) by Prim over all pairs, ordered by weight at 9 places, then ids."""
    ids = np.array(sorted(points))
    at = np.array([points[i] for i in ids], dtype=float)
    d = np.sqrt(((at[:, None, :] - at[None, :, :]) ** 2).sum(axis=2))
    core = np.sort(d, axis=1)[:, min(k, len(ids)) - 1]
    w = np.round(np.maximum(np.maximum(d, core[:, None]), core[None, :]), 9)
    inside, out = {0}, []
    while len(inside) < len(ids):
        weight, a, b, new = min((w[i, j], min(ids[i], ids[j]), max(ids[i], ids[j]), j) for i in inside for j in range(len(ids)) if j not in inside)
        out.append((int(a), int(b), float(weight)))
        inside.add(new)
    return sorted(out)


def tree(spark, points, k, **options):
    rows = [(int(i), float(p[0]), float(p[1])) for i, p in points.items()]
    return sorted((r["a"], r["b"], r["weight"]) for r in mutual_reachability_forest(spark.createDataFrame(rows, COLS), k, **options).collect())


def same(got, want):
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert all(abs(x[2] - y[2]) < 2e-9 for x, y in zip(got, want))


def test_tree_of_uneven_blobs_and_outliers(spark):
    rng = np.random.default_rng(4)
    at = np.concatenate([rng.normal(0, 0.02, (60, 2)), rng.normal(3, 1, (50, 2)), rng.normal((-4, 2), 0.3, (40, 2)), [[400, -90], [1e6, 3]]])
    points = {int(i) * 7: p for i, p in zip(rng.permutation(len(at)), at)}
    same(tree(spark, points, 5), plain_tree(points, 5))


def test_blocks_of_a_crowded_cell_and_ties(spark, monkeypatch):
    monkeypatch.setattr("playstats.operators.reachability.BLOCK", 8)
    points = {10 * i + j: (i, j) for i in range(8) for j in range(8)}          # a lattice: all weights tie
    same(tree(spark, points, 2), plain_tree(points, 2))


def test_copies_and_unusable_points(spark):
    rows = [(1, 0.0, 0.0), (2, -0.0, 0.0), (3, 0.0, 0.0), (4, 1.0, 0.0), (4, 9.0, 0.0), (5, None, 1.0), (6, float("nan"), 1.0),
            (7, float("inf"), 0.0), (None, 2.0, 2.0), (8, 3.0, 0.0)]
    out = mutual_reachability_forest(spark.createDataFrame(rows, COLS), 2).collect()
    assert sorted((r["a"], r["b"], r["weight"]) for r in out) == [(1, 2, 0.0), (1, 3, 0.0), (1, 4, 1.0), (4, 8, 2.0)]
    assert mutual_reachability_forest(spark.createDataFrame([], COLS), 3).count() == 0
    assert mutual_reachability_forest(spark.createDataFrame([(1, 0.0, 0.0)], COLS), 3).count() == 0


def test_points_go_to_the_cell_of_their_nearest_pivot(spark):
    from playstats.operators.knn import _pivots
    from playstats.operators.reachability import _deal
    from pyspark.sql import functions as F
    points = [(i, float(i % 20), float(i // 20) * 1.5, 0.0) for i in range(300)]
    classes = spark.createDataFrame(points, "id long, x double, y double, core double")
    pivots = _pivots(classes.select(F.col("id").alias("rep"), F.array("x", "y").alias("vec"), F.lit(1.0).alias("length")), 300)
    assert {tuple(p) for p in pivots} <= {(x, y) for _, x, y, _ in points}          # as given, not scaled
    dealt = _deal(classes, 300).collect()
    assert len(dealt) == 300 and len({r["cell"] for r in dealt}) == len(pivots) > 5
    for r in dealt:
        d = np.hypot(*(pivots - [r["x"], r["y"]]).T)
        assert d[r["cell"]] <= d.min() + 1e-9
