import math
import random

import numpy as np
import pytest

from playstats.llm.ann import _fit_on_executor, nearest_neighbours
from playstats.llm.topk import exact_top_k

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def table(n, dim, seed=3, hot=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.sqrt((x ** 2).sum(axis=1, keepdims=True))
    x = x.astype(np.float32)
    x[n - hot:] = x[0]
    return [(i, [float(v) for v in x[i]], 0, "r", "s") for i in range(n)]


def odd_rows():
    return [(2000, None, 0, "", ""), (2100, [1.0, None, 0.0, 0.0], 0, "", ""), (2200, [math.nan, 0.0, 0.0, 0.0], 0, "", ""),
            (2300, [math.inf, 0.0, 0.0, 0.0], 0, "", ""), (2400, [], 0, "", ""), (None, [1.0, 0.0, 0.0, 0.0], 0, "", "")]


def brute(rows, k, every, whole):
    good = {}
    for i, v, *_ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        if not whole and not any(v):
            continue
        v = [math.floor(1024 * x) for x in v] if whole else v
        good[i] = min(good.get(i, v), v)
    out = []
    for q, v in good.items():
        if q % every == 0:
            s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q and len(w) == len(v))
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("hot", [0, 400])
def test_exact_top_k_is_exact(spark, hot):
    rows = table(1200, 12, hot=hot) + odd_rows() + table(3, 12)[:1]
    rows += [(3000, [0.0] * 12, 0, "", ""), (3100, [0.5, 0.25], 0, "", "")]
    got = sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == brute(rows, 10, 100, True)


def test_exact_top_k_many_blocks(spark, monkeypatch):
    from playstats.llm import vectors
    monkeypatch.setattr(vectors, "QUERY_BLOCK", 5)
    monkeypatch.setattr(vectors, "CANDIDATE_BLOCK", 100)
    rows = table(900, 6)
    got = sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, SCHEMA), every=30).collect()))
    assert got == brute(rows, 10, 30, True)


def test_fewer_candidates_and_empty(spark):
    rows = table(4, 5)
    got = sorted(map(tuple, exact_top_k(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == brute(rows, 10, 100, True) and len(got) == 3
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_top_k(empty).count() == 0 and nearest_neighbours(empty).count() == 0
    one = spark.createDataFrame(rows[:1], SCHEMA)
    assert exact_top_k(one).count() == 0 and nearest_neighbours(one).count() == 0


def recall(got, want):
    near = lambda rows: {(q, i) for q, _, i, _ in rows}
    return len(near(got) & near(want)) / len(near(want))


@pytest.mark.parametrize("sample", [20_000, 700])
def test_nearest_neighbours_recall_and_scores(spark, sample):
    rows = table(3000, 32) + odd_rows() + [(4000, [0.0] * 32, 0, "", "")]
    got = sorted(map(tuple, nearest_neighbours(spark.createDataFrame(rows, SCHEMA), sample=sample).collect()))
    want = brute(rows, 20, 20, False)
    assert len(got) == len(want) and [g[:2] for g in got] == [w[:2] for w in want]
    assert recall(got, want) >= 0.95
    scores = {(q, i): s for q, _, i, s in brute(rows, 10 ** 6, 20, False)}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, _, i, s in got)


def test_nearest_neighbours_ties_norms_and_few(spark):
    rows = table(300, 8, hot=100)
    got = sorted(map(tuple, nearest_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()))
    hot = [g for g in got if g[0] == 220]
    assert [g[2] for g in hot] == [0, *range(200, 219)]        # equal scores: smaller ids first
    rnd = random.Random(5)
    long = [(i, [x * rnd.choice([1, 5]) for x in v], *r) for i, v, *r in table(2000, 16)]
    got = sorted(map(tuple, nearest_neighbours(spark.createDataFrame(long, SCHEMA)).collect()))
    assert recall(got, brute(long, 20, 20, False)) >= 0.9
    few = table(6, 8)
    got = sorted(map(tuple, nearest_neighbours(spark.createDataFrame(few, SCHEMA)).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in brute(few, 20, 20, False)]


def test_codes_keep_neighbours_within_the_learned_radius(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 24))
    drawn = spark.createDataFrame([(v.tolist(),) for v in x], "vec array<double>")
    model = _fit_on_executor(drawn, float(np.sqrt((x ** 2).sum(axis=1)).max()), 20)
    assert 0 < model["radius"] < 4 * 24 and model["axes"].shape == (25, 96)
