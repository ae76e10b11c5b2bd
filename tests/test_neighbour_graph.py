"""Neighbour weights against plain Python, and their invariants."""

import math
import random

import pytest

from playstats.operators.neighbour_graph import directed_weights, knn_graph, neighbour_weights, node_scales

K = 8


def points(spark, n=160):
    rnd = random.Random(2)
    rows = [(i, [rnd.gauss(3 * (i % 4), 1) for _ in range(4)]) for i in range(n)]
    rows += [(500 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(12)]      # more copies than neighbours
    rows += [(600 + i, [0.0, 0.0, 0.0, float(i + 1)]) for i in range(3)]
    return spark.createDataFrame(rows, "track_id long, features array<double>")


def plain_scale(ds, k):
    positive = [d for d in ds if d > 0]
    rho = min(positive, default=0.0)
    low, high = 0.0, max(max(d - rho, 0) for d in ds) / math.log(k / math.log2(k))
    for _ in range(64):
        mid = (low + high) / 2
        total = sum(1.0 if d <= rho else math.exp(-(d - rho) / mid) if mid else 0.0 for d in ds)
        low, high = (mid, high) if total < math.log2(k) else (low, mid)
    return rho, max(high, 1e-3 * sum(ds) / len(ds))


def test_scales_and_weights_against_plain_python(spark):
    edges = knn_graph(points(spark), K, metric="l2").cache()
    by = {}
    for r in edges.collect():
        by.setdefault(r["src"], []).append((r["dst"], r["dist"]))
    assert all(len(v) == K for v in by.values())
    want = {}
    for r in node_scales(edges, K).collect():
        rho, sigma = plain_scale([d for _, d in by[r["src"]]], K)
        assert abs(r["rho"] - rho) < 1e-12 and abs(r["sigma"] - sigma) < 1e-9 * max(1, sigma)
        want |= {(r["src"], j): 1.0 if d <= rho else math.exp(-(d - rho) / sigma) for j, d in by[r["src"]]}
    got = {(r["src"], r["dst"]): r["weight"] for r in directed_weights(edges, K).collect()}
    assert got.keys() == want.keys() and all(abs(got[e] - want[e]) < 1e-9 for e in got)
    for src, near in by.items():      # the weights of a row sum to log2 k where a sigma can do it
        if sum(d <= plain_scale([x for _, x in near], K)[0] for _, d in near) < math.log2(K):
            assert abs(sum(got[src, j] for j, _ in near) - math.log2(K)) < 1e-6
    both = {(r["src"], r["dst"]): r["weight"] for r in neighbour_weights(edges, K).collect()}
    for (i, j), w in both.items():
        a, b = want.get((i, j), 0.0), want.get((j, i), 0.0)
        assert abs(w - (a + b - a * b)) < 1e-9 and both[j, i] == pytest.approx(w, abs=1e-12)
    assert both.keys() == want.keys() | {(j, i) for i, j in want}
    edges.unpersist()


def test_weights_need_no_python(spark):
    plan = neighbour_weights(spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.7)], "src long, dst long, dist double"), 2)
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {(r["src"], r["dst"]) for r in plan.collect()} == {(1, 2), (2, 1), (1, 3), (3, 1)}


def test_an_edge_is_shuffled_once_for_its_row_and_once_for_its_pair(spark):
    edges = [(1, 2, 0.5), (1, 3, 0.7), (2, 1, 0.5), (2, 3, 0.9), (3, 1, 0.7), (3, 2, 0.9)]
    weights = neighbour_weights(spark.createDataFrame(edges, "src long, dst long, dist double"), 2)
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert sorted((r["src"], r["dst"]) for r in weights.collect()) == [(1, 2), (1, 3), (2, 1), (2, 3), (3, 1), (3, 2)]


def test_scales_of_odd_rows_settle_or_are_halved(spark, monkeypatch):
    k = 30
    rows = {1: [10.0 ** (-2 * j) for j in range(k)], 2: [0.0] * 5 + [1.0] * 25, 3: [0.0] * 29 + [2.0], 4: [1.0 + 1e-9 * j for j in range(k)], 5: [0.0] * k,
            6: [3.0] * k, 7: [0.5, 0.25], 8: [1.0] * 4 + [1e300] * 26, 9: [1e-300 * (j + 1) for j in range(k)], 10: [7.0]}
    edges = spark.createDataFrame([(i, j, d) for i, ds in rows.items() for j, d in enumerate(ds)], "src long, dst long, dist double")
    for settled in (None, -1.0):       # by Newton's steps; by halving alone
        if settled:
            monkeypatch.setattr("playstats.operators.neighbour_graph.SETTLED", settled)
        for r in node_scales(edges, k).collect():
            rho, sigma = plain_scale(rows[r["src"]], k)
            assert r["rho"] == rho and abs(r["sigma"] - sigma) <= 1e-9 * sigma, r
