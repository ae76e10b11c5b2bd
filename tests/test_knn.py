"""The exact nearest-neighbour join against all pairs in plain numpy."""

import math
import random

import numpy as np
import pytest

from playstats.operators import knn
from playstats.operators.knn import all_pairs_topk, nearest_neighbours

SCHEMA = "id long, vector array<double>, rank string"


def brute(rows, k, metric):
    good = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and (metric == "l2" or any(v)):
            good[i] = min(good.get(i, v), v)
    ids = np.asarray(sorted(good))
    x = np.asarray([good[i] for i in ids.tolist()], dtype=float)
    out = []
    if metric == "cosine":
        x = x / np.sqrt((x * x).sum(axis=1))[:, None]
    for a in range(len(ids)):
        d = 1 - (x * x[a]).sum(axis=1) if metric == "cosine" else np.sqrt(((x - x[a]) ** 2).sum(axis=1))
        best = sorted((round(float(y), 9) + 0.0, int(b)) for b, y in zip(ids, d) if b != ids[a])[:k]
        out += [(int(ids[a]), r + 1, b, y) for r, (y, b) in enumerate(best)]
    return out


def got(spark, rows, k, metric):
    df = all_pairs_topk(spark.createDataFrame(rows, SCHEMA), k, metric=metric)
    return sorted((r["id"], r["rank"], r["neighbour_id"], round(r["distance"], 9) + 0.0) for r in df.collect())


def same(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert all(abs(x[3] - y[3]) < 2e-9 for x, y in zip(a, b))


def clustered(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, dim)) * 6
    x = centres[rng.integers(0, 8, n)] + rng.standard_normal((n, dim))
    return [(i, [float(a) for a in v], "r") for i, v in enumerate(x)]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_equals_all_pairs(spark, metric, monkeypatch):
    monkeypatch.setattr(knn, "BLOCK", 64)        # cells of several blocks, blocks of several portions
    rows = clustered(300, 5)
    rnd = random.Random(1)
    rows += [(1000 + i, [1.0, 2.0, 0.0, -1.0, 3.0], "hot") for i in range(200)]          # a third of all rows are one vector
    rows += [(2000 + i, [float(rnd.randint(0, 2)) for _ in range(5)], "ties") for i in range(60)]
    rows += [(3000, None, "r"), (3001, [1.0, None, 0.0, 0.0, 0.0], "r"), (3002, [math.nan] * 5, "r"), (3003, [], "r"),
             (3004, [0.0] * 5, "r"), (3005, [0.0] * 5, "r"), (None, [1.0] * 5, "r"), (3, rows[4][1], "again"), (3006, [1e9, 0.0, 0.0, 0.0, 0.0], "far")]
    same(got(spark, rows, 7, metric), sorted(brute(rows, 7, metric)))


def test_few_rows_and_none(spark):
    rows = clustered(4, 3)
    same(got(spark, rows, 10, "l2"), sorted(brute(rows, 10, "l2")))
    assert got(spark, [], 3, "cosine") == [] and got(spark, [(1, [1.0, 2.0], "r")], 3, "l2") == []
    copies = [(i, [1.0, 1.0], "r") for i in range(5)]
    same(got(spark, copies, 3, "cosine"), sorted(brute(copies, 3, "cosine")))
    with pytest.raises(ValueError):
        all_pairs_topk(spark.createDataFrame([(1, [1.0], "r"), (2, [1.0, 2.0], "r")], SCHEMA))


def test_most_cells_are_never_visited(spark):
    """Points in the plane: a row needs its own and the neighbouring cells only."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(a) for a in v], "r") for i, v in enumerate(rng.random((4000, 2)))]
    found = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), 5, metric="l2")
    assert found.cells > 50 and found.visited < 0.15
    same(sorted((r["id"], r["rank"], r["neighbour_id"], round(r["distance"], 9)) for r in found.rows.filter("id < 300").collect()),
         [x for x in sorted(brute(rows, 5, "l2")) if x[0] < 300])


def test_rows_are_sent_to_blocks_not_to_cells(spark):
    """Among vectors of many dimensions hardly a cell can be left out; a row still asks each block once at most."""
    rows = [(i, [float(a) for a in v], "r") for i, v in enumerate(np.random.default_rng(5).standard_normal((7000, 24)))]
    for metric in ("l2", "cosine"):
        found = nearest_neighbours(spark.createDataFrame(rows, SCHEMA), 6, metric=metric)
        assert found.visited > 0.5 and found.cells > 4 * knn.SPREAD and 1 <= found.sent <= knn.SPREAD + 4
        same(sorted((r["id"], r["rank"], r["neighbour_id"], round(r["distance"], 9)) for r in found.rows.filter("id < 100").collect()),
             [x for x in sorted(brute(rows, 6, metric)) if x[0] < 100])


def test_single_precision_filter_leaves_nothing_out(spark):
    """Far from the origin, and at sizes beyond single precision, differences are below its rounding."""
    rng = np.random.default_rng(6)
    for shift, scale in ((1e4, 1e-2), (0.0, 1e18), (0.0, 1e-25)):
        x, y = (shift + scale * rng.random((n, 5)) for n in (50, 400))
        products = x @ y.T
        least = np.sort(products, axis=1)[:, -7]
        i = np.divmod(knn._products_over(x, y, least), 400)
        assert set(zip(*(a.tolist() for a in np.nonzero(products >= least[:, None])))) <= set(zip(*(a.tolist() for a in i)))


def test_blocks_meet_once_with_the_components_as_given(spark):
    """Single-precision vectors travel as such, two blocks meet in one group for both directions, and the result is exact."""
    rows = [(i, [float(a) for a in np.float32(v)], "r") for i, (_, v, _) in enumerate(clustered(1200, 12, seed=4))]
    frame = spark.createDataFrame(rows, "id long, vector array<float>, rank string")
    for metric in ("l2", "cosine"):
        found = nearest_neighbours(frame, 6, metric=metric).rows
        plan = found._jdf.queryExecution().analyzed().toString()
        assert "CoGroup" not in plan
        same(sorted((r["id"], r["rank"], r["neighbour_id"], round(r["distance"], 9)) for r in found.collect()), sorted(brute(rows, 6, metric)))
