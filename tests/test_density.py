"""Core distances against all pairs."""

import math
import random

import numpy as np

from playstats.operators.density import core_distances

SCHEMA = "track_id long, x double, y double, core string"


def brute(points, k):
    good = {}
    for i, x, y, *_ in points:
        if None not in (i, x, y) and math.isfinite(x) and math.isfinite(y):
            good[i] = min(good.get(i, (x, y)), (x, y))
    at = np.asarray(list(good.values()))
    return {i: float(np.sort(np.sqrt(((at - p) ** 2).sum(axis=1)))[:k][-1]) for i, p in good.items()}


def test_against_all_pairs(spark):
    rnd = random.Random(4)
    points = [(i, rnd.gauss(0, 1), rnd.gauss(0, 0.2), "") for i in range(500)]
    points += [(600 + i, 5 + rnd.gauss(0, 0.01), 5.0, "") for i in range(60)]
    points += [(700 + i, -3.0, 2.0, "") for i in range(30)]                      # one spot, more points than k
    points += [(800, 1e4, -1e4, "far"), (801, None, 0.0, ""), (802, math.nan, 0.0, ""), (None, 0.0, 0.0, ""), (5, 9.0, 9.0, "again")]
    got = {r["track_id"]: r["core"] for r in core_distances(spark.createDataFrame(points, SCHEMA), 20).collect()}
    want = brute(points, 20)
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-8 * max(1, want[i]) for i in want)
    assert got[700] == 0 and got[800] > 1e4


def test_few_points(spark):
    points = [(1, 0.0, 0.0, ""), (2, 3.0, 4.0, "")]
    assert {r["track_id"]: r["core"] for r in core_distances(spark.createDataFrame(points, SCHEMA), 20).collect()} == {1: 5.0, 2: 5.0}
    assert [r["core"] for r in core_distances(spark.createDataFrame(points[:1], SCHEMA), 20).collect()] == [0.0]
    assert core_distances(spark.createDataFrame([], SCHEMA), 20).count() == 0
