"""The spectral layout against a dense eigen-solve."""

import numpy as np
import pandas as pd
import pytest

from playstats.operators.neighbour_graph import knn_graph, neighbour_weights
from playstats.operators.spectral import component_labels, spectral_layout

EDGES = "src long, dst long, weight double"


def dense(spark, edges):
    """(nodes, eigenvalues, eigenvectors) by falling size, solved in a Spark task, not beside the JVM."""
    nodes = sorted({e[0] for e in edges})
    at = {v: i for i, v in enumerate(nodes)}
    w = np.zeros((len(nodes),) * 2)
    for i, j, x in edges:
        w[at[i], at[j]] += x
    d = w.sum(axis=1)
    a = w / np.sqrt(d[:, None] * d[None, :])

    def solve(frames):
        for pdf in frames:
            if len(pdf):
                value, vector = np.linalg.eigh(a)
                yield pd.DataFrame({"value": value[::-1], "vector": vector.T[::-1].tolist()})

    got = spark.range(1).repartition(1).mapInPandas(solve, "value double, vector array<double>").collect()
    return nodes, [r["value"] for r in got], np.asarray([r["vector"] for r in got]).T


def unit(v):
    return v / np.sqrt((v * v).sum(axis=0))


def test_agrees_with_a_dense_solve_on_500_points(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((500, 3)) * [3.0, 2.0, 1.0]
    points = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)], "track_id long, features array<double>")
    weights = neighbour_weights(knn_graph(points, 10, metric="l2"), 10).cache()
    out = {r["node"]: (r["x"], r["y"]) for r in spectral_layout(weights).collect()}
    nodes, values, vectors = dense(spark, [tuple(r) for r in weights.select("src", "dst", "weight").collect()])
    assert values[1] < 1 - 1e-6 and sorted(out) == nodes
    got = np.asarray([out[v] for v in nodes])
    for i in range(2):
        cosine = abs((unit(got[:, i]) * vectors[:, i + 1]).sum())
        assert cosine > 1 - 1e-6
        assert got[np.abs(got[:, i]).argmax(), i] > 0
    weights.unpersist()


def path(nodes, weight=1.0):
    return [(a, b, weight) for a, b in zip(nodes, nodes[1:])] + [(b, a, weight) for a, b in zip(nodes, nodes[1:])]


def test_components_apart_and_tiny_ones(spark):
    edges = path(range(0, 40)) + path(range(100, 125), 2.5) + path([200, 201]) + path([300, 301, 302]) + [(400, 400, 1.0), (401, 402, 0.0)]
    frame = spark.createDataFrame(edges, EDGES)
    out = {r["node"]: np.asarray([r["x"], r["y"]]) for r in spectral_layout(frame).collect()}
    assert set(out) == {*range(40), *range(100, 125), 200, 201, 300, 301, 302}
    for part in (list(range(40)), list(range(100, 125))):
        _, _, vectors = dense(spark, [e for e in edges if e[0] in part])
        got = np.asarray([out[v] for v in part])
        for i in range(2):
            assert abs((unit(got[:, i]) * vectors[:, i + 1]).sum()) > 1 - 1e-6
    assert abs(abs(out[200][0]) - np.sqrt(0.5)) < 1e-9 and out[200][1] == 0
    labels = {r["node"]: r["comp"] for r in component_labels(frame.filter("src <> dst and weight > 0")).collect()}
    assert labels[39] == 0 and labels[124] == 100 and labels[302] == 300


def test_unconverged_raises_and_empty_is_empty(spark):
    ring = path([*range(300), 0])
    with pytest.raises(RuntimeError, match="not converged"):
        spectral_layout(spark.createDataFrame(ring, EDGES), tolerance=1e-12, rounds=1)
    assert spectral_layout(spark.createDataFrame([], EDGES)).count() == 0


def test_a_product_sums_in_few_parts(spark):
    from pyspark.sql import functions as F

    from playstats.operators.spectral import _matrix, _product
    edges = path(range(30)) + path([0, 7, 29], 2.0)
    state = spark.range(30).select(F.col("id").alias("node"), F.lit(0).cast("long").alias("comp"), F.lit(-0.5).alias("mid"),
                                   F.lit(0.5).alias("half"), (F.col("id") * 1.5).alias("y0"), F.lit(0.0).alias("p0"))
    out = _product(_matrix(spark.createDataFrame(edges, EDGES)), state, 1, 1.0, 3, last=True)
    assert "Coalesce 3" in out._jdf.queryExecution().executedPlan().toString()
    w = np.zeros((30, 30))
    for i, j, x in edges:
        w[i, j] += x
    d = w.sum(axis=1)
    want = (w / np.sqrt(d[:, None] * d)) @ (np.arange(30) * 1.5)
    got = {r["node"]: r["z0"] for r in out.collect()}
    assert all(abs(got[i] - want[i]) < 1e-9 for i in range(30))


def blocks(spark, edges, n):
    from playstats.operators.spectral import _keys, _packed, _parts, _stars
    keys = _keys(spark, n)
    packed = _packed(spark.createDataFrame(edges, EDGES), keys)
    return keys, _parts(packed, n), _stars(packed)


def test_a_product_of_parts_is_that_of_rows_and_moves_only_vectors(spark):
    from pyspark.sql import functions as F

    from playstats.operators.spectral import _matrix, _product, _start, _step
    edges = path(range(30)) + path([0, 7, 29], 2.0) + path([5, 6], 0.5) + path([2 ** 60, 2 ** 60 + 1]) + [(3, 99, 1.0)]     # 99 has no edges of its own
    keys, parts, stars = blocks(spark, edges, 3)
    labels = component_labels(stars)
    first = _start(parts, labels, keys, 2)
    out = _step(parts, _step(parts, first, 2, 1.0), 2, 1.0, last=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(part" in line and "ENSURE_REQUIREMENTS" in line]
    assert "Join" not in plan and len(shuffles) == 3          # the start's and one a product, none of the parts
    state = labels.select("node", "comp", F.lit(-0.5).alias("mid"), F.lit(0.5).alias("half"),
                          *[(F.xxhash64("node", F.lit(i)) / float(2 ** 63)).alias(f"y{i}") for i in range(2)],
                          *[F.lit(0.0).alias(f"p{i}") for i in range(2)])
    full = _matrix(spark.createDataFrame(edges + [(99, 3, 1.0)], EDGES)).filter("99 not in (src, dst)")
    full = full.cache()
    state = state.filter("node <> 99")
    want = {r["node"]: r for r in _product(full, _product(full, state, 2, 1.0, 3), 2, 1.0, 3, last=True).collect()}
    got, comps = {}, {}
    held = {r["part"]: np.frombuffer(r["nodes"], np.int64) for r in parts.select("part", "nodes").collect()}
    for r in out.collect():
        values = np.frombuffer(r["data"]).reshape(5, -1)
        comps |= dict(zip(held[r["part"]].tolist(), values[4].copy().view(np.int64).tolist()))
        got |= {v: values[:4, i] for i, v in enumerate(held[r["part"]].tolist())}
    assert sorted(got) == sorted(want) and comps[2 ** 60 + 1] == 2 ** 60 and comps[29] == 0
    for v, r in want.items():
        assert np.allclose(got[v], [r["y0"], r["y1"], r["z0"], r["z1"]], rtol=0, atol=1e-9)
    parts.unpersist()
    full.unpersist()


def test_parts_leave_a_row_a_node_for_the_labels(spark):
    edges = [(i, j, 1.0) for c in (0, 1000) for i in range(c, c + 60) for j in range(c, c + 60) if i != j]      # two cliques
    _, parts, stars = blocks(spark, edges, 3)
    assert stars.count() <= 2 * 3 * 120 < len(edges)
    labels = {r["node"]: r["comp"] for r in component_labels(stars).collect()}
    assert labels == {**{i: 0 for i in range(60)}, **{i: 1000 for i in range(1000, 1060)}}
    parts.unpersist()
