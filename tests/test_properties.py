"""Property checks (hypothesis) on small random inputs."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from playstats.operators.similarity import cosine_to_target

COLS = ("a", "b", "c")
vec = st.tuples(*[st.floats(-5, 5, allow_nan=False, width=32) for _ in COLS])


@settings(max_examples=8, deadline=None)
@given(st.lists(vec, min_size=2, max_size=12))
def test_cosine_bounded_and_symmetric(spark, vectors):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(vectors)],
                               "track_id long, a double, b double, c double")
    sims = {}
    for t in range(min(len(vectors), 3)):
        target = df.filter(F.col("track_id") == t)
        for r in cosine_to_target(df, target, COLS).collect():
            sims[(t, r.track_id)] = r.cosine_similarity
            assert -1 - 1e-9 <= r.cosine_similarity <= 1 + 1e-9
    for (i, j), s in sims.items():
        if (j, i) in sims:
            assert math.isclose(s, sims[(j, i)], rel_tol=1e-9, abs_tol=1e-12)
    # zero vectors never appear (NULL similarity is dropped, as in the SQL)
    zero = {i for i, v in enumerate(vectors) if all(x == 0 for x in v)}
    assert not any(j in zero or i in zero for i, j in sims)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6)), min_size=1, max_size=60),
       st.integers(1, 4))
def test_rank_filter_equals_full_sort(spark, rows, k):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(rows)], "id long, g long, v long")
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    got = {r.id for r in df.withColumn("r", F.rank().over(w)).filter(F.col("r") <= k).collect()}
    expect = set()
    for g in {g for g, _ in rows}:
        vals = sorted((v for gg, v in rows if gg == g), reverse=True)
        cut = vals[min(k, len(vals)) - 1]
        expect |= {i for i, (gg, v) in enumerate(rows) if gg == g and v >= cut}
    assert got == expect
