import math
import random

import numpy as np
import pytest

from playstats.llm.whitening import eigen, fit_whitening, one_sided_jacobi, pivoted_cholesky, whiten, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, whitened string, n string"


def table(n, dim, seed=1, rank=None):
    rnd = random.Random(seed)
    mix = [[rnd.gauss(0, 1) * 0.7 ** j for _ in range(dim)] for j in range(rank or dim)]
    rows = []
    for i in range(n):
        z = [rnd.gauss(0, 1) for _ in mix]
        rows.append((i, [float(np.float32(sum(a * m[d] for a, m in zip(z, mix)) / 4)) for d in range(dim)], 0, "w", "n"))
    return rows


def odd_rows():
    return [(900, None, 0, "", ""), (901, [0.1, None, 0.2, 0.3, 0.4], 0, "", ""), (902, [math.nan] * 5, 0, "", ""),
            (903, [0.0, math.inf, 0.0, 0.0, 0.0], 0, "", ""), (904, [], 0, "", ""), (None, [0.1, 0.2, 0.3, 0.4, 0.5], 0, "", ""),
            (3, [0.5, 0.4, 0.3, 0.2, 0.1], 0, "", ""), (3, [0.5, 0.4, 0.3, 0.2, 0.1], 0, "", "")]


def whole(rows):
    return [(i, [math.floor(1024 * c) + 100000 for c in v]) for i, v, *_ in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]


def covariance(xs):
    n, d = len(xs), len(xs[0])
    mean = [sum(x[i] for x in xs) / n for i in range(d)]
    y = [[a - m for a, m in zip(x, mean)] for x in xs]
    return mean, [[math.fsum(r[i] * r[j] for r in y) / n for j in range(d)] for i in range(d)]


def check(out, xs_by_id, xs, k):
    """``out`` against sums in plain Python: deviations, unit variances, no correlation, share of the trace."""
    n, d = len(xs), len(xs[0])
    sums = [sum(x[i] for x in xs) for i in range(d)]
    mean, v = covariance(xs)
    trace = sum(v[i][i] for i in range(d))
    assert len(out) == n * k
    for r in out:
        dev = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in xs_by_id[r["vec_id"]]]
        assert r["n"] == n and r["deviation"] in dev and r["identity_error"] <= 1e-4
    for c in range(1, k + 1):
        w = [r["whitened"] for r in out if r["component"] == c]
        assert abs(math.fsum(w)) < 1e-6 * n and abs(math.fsum(a * a for a in w) / n - 1) < 1e-8
    shares = [next(r["explained"] for r in out if r["component"] == c) for c in range(1, k + 1)]
    assert shares == sorted(shares, reverse=True)
    # the projection is one on an eigenvector: V a = e a, with a recovered from the covariance of x and whitened
    for c in range(1, k + 1):
        e = shares[c - 1] * trace
        pairs = {}
        for r in out:
            if r["component"] == c:
                pairs.setdefault(r["vec_id"], []).append(r["whitened"])
        a = [math.fsum((x[i] - mean[i]) * w for key, ws in pairs.items()
                       for x, w in zip(sorted(xs_by_id[key]), sorted(ws))) / n / math.sqrt(e) for i in range(d)]
        if all(len(set(map(tuple, x))) == 1 for x in xs_by_id.values()):
            assert abs(sum(q * q for q in a) - 1) < 1e-8
            for i in range(d):
                assert abs(sum(v[i][j] * a[j] for j in range(d)) - e * a[i]) < 1e-8 * trace


def test_against_plain_python(spark):
    rows = table(300, 5) + [r for r in odd_rows() if r[0] != 3]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    xs = whole(rows)
    by_id = {}
    for i, x in xs:
        by_id.setdefault(i, []).append(x)
    check(out, by_id, [x for _, x in xs], 5)


def test_repeated_ids_and_eight_components(spark):
    rows = [r for r in table(200, 12)] + table(3, 12)
    out = whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    by_id = {}
    for i, x in whole(rows):
        by_id.setdefault(i, []).append(x)
    check(out, by_id, [x for xs in by_id.values() for x in xs], 8)


def test_lengths_fit_apart_and_components_without_variance(spark):
    rows = table(40, 4) + [(500 + i, v, 0, "", "") for i, v, *_ in table(30, 3, seed=9)] + [(700, [0.25] * 6, 0, "", "")]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["n"] for r in out if r["vec_id"] < 500} == {40} and {r["n"] for r in out if 500 <= r["vec_id"] < 700} == {30}
    alone = [r for r in out if r["vec_id"] == 700]
    assert len(alone) == 6 and all(r["whitened"] is None and r["explained"] == 0 and r["deviation"] == 0
                                   and r["identity_error"] == 0 for r in alone)
    same = whiten(spark.createDataFrame([(i, [0.5, 0.5], 0, "", "") for i in range(4)], SCHEMA)).collect()
    assert len(same) == 8 and all(r["whitened"] is None for r in same)
    line = whiten(spark.createDataFrame([(i, [i / 8, i / 4], 0, "", "") for i in range(9)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert all(abs(r["explained"] - 1) < 1e-12 for r in line if r["component"] == 1)


def test_empty_table(spark):
    out = whiten(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_and_exact_deviation(spark):
    rows = [(1, [2.0 ** 30, 0.0], 0, "", ""), (2, [0.0, 1.0], 0, "", ""), (3, [3.0e38, 0.0], 0, "", "")]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["vec_id"] for r in out} == {1, 2} and all(r["deviation"] is None for r in out)
    rows = [(i, [float(100 * i)], 0, "", "") for i in range(50)]
    out = whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    xs = [102400 * i + 100000 for i in range(50)]
    assert sorted(r["deviation"] for r in out) == sorted((50 * x - sum(xs)) ** 2 for x in xs)


def test_eigen_of_graded_matrices_keeps_small_values():
    """Columns scaled over 12 orders of ten: every eigenvalue to a relative 1e-10, by an exact 2 x 2 block each."""
    scale = [10.0 ** -i for i in range(7)]
    blocks = np.zeros((14, 14))
    want = []
    for i, s in enumerate(scale):
        a, b, c = 2 * s * s, 0.5 * s * s, 1 * s * s
        blocks[2 * i:2 * i + 2, 2 * i:2 * i + 2] = [[a, b], [b, c]]
        root = math.sqrt((a - c) ** 2 + 4 * b * b)
        want += [(a + c + root) / 2, (a + c - root) / 2]
    shuffled = np.random.default_rng(0).permutation(14)
    values, vectors = eigen(blocks[shuffled][:, shuffled])
    assert np.allclose(values, sorted(want, reverse=True), rtol=1e-10, atol=0)
    gram = (vectors[:, :, None] * vectors[:, None, :]).sum(axis=0)
    assert np.abs(gram - np.eye(14)).max() < 1e-12


def test_cholesky_pivots_and_jacobi_orthogonalises():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((40, 9)) * np.geomspace(1, 100, 9)
    scatter = (x[:, :, None] * x[:, None, :]).sum(axis=0)
    factor, order = pivoted_cholesky(scatter)
    again = (factor[:, None, :] * factor[None, :, :]).sum(axis=2)
    assert np.allclose(again, scatter[order][:, order], rtol=1e-10) and np.all(np.diff(np.diag(factor)) <= 1e-9)
    turned = one_sided_jacobi(factor)
    gram = (turned[:, :, None] * turned[:, None, :]).sum(axis=0)
    size = np.sqrt(np.diag(gram))
    assert np.abs(gram / size[:, None] / size - np.eye(9)).max() < 1e-13


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_on_tables(spark, sf):
    from playstats.llm.queries import op12_embedding_whitening
    out = op12_embedding_whitening(spark, f"/root/testdata/{sf}").collect()
    xs = [list(x) for _, x in ((r["vec_id"], r["x"]) for r in whole_vectors(
        spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")).collect())]
    assert len(out) == 8 * len(xs) and max(r["identity_error"] for r in out) <= 1e-10


def test_components_are_eigenvectors_to_double_precision(spark):
    vectors = whole_vectors(spark.createDataFrame(table(400, 10, seed=4), SCHEMA))
    (fit,) = fit_whitening(vectors, 10).values()
    _, v = covariance([list(r["x"]) for r in vectors.collect()])
    v = np.asarray(v)
    moved = (v[:, :, None] * fit["basis"][None, :, :]).sum(axis=1)
    assert np.abs(moved - fit["basis"] * fit["values"]).max() < 1e-12 * fit["trace"]
