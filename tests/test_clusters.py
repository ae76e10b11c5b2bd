import random
from collections import Counter

from pyspark.sql import functions as F

from playstats.operators import clusters as CL
from playstats.plans import recommend as RC


def _blobs(spark, partitions=3):
    rnd = random.Random(3)
    pts = []
    centres = [(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)]
    for c, (cx, cy) in enumerate(centres):
        for _ in range(40):
            pts.append((len(pts), cx + rnd.gauss(0, 0.3), cy + rnd.gauss(0, 0.3), c))
    for _ in range(15):                       # a blob below min_cluster_size
        pts.append((len(pts), 10 + rnd.gauss(0, 0.2), 10 + rnd.gauss(0, 0.2), -1))
    for _ in range(10):                       # scattered points
        pts.append((len(pts), rnd.uniform(-20, 30), rnd.uniform(-20, -10), -1))
    return spark.createDataFrame(pts, "id long, x double, y double, truth int").repartition(partitions)


def test_density_clusters_recover_blobs(spark):
    out = CL.density_clusters(_blobs(spark), min_cluster_size=20).collect()
    by_truth = {}
    for r in out:
        by_truth.setdefault(r.truth, Counter())[r.cluster] += 1
    found = set()
    for t in (0, 1, 2):
        (cl, n), = by_truth[t].most_common(1)
        assert cl != CL.NOISE and n >= 38
        found.add(cl)
    assert len(found) == 3
    assert set(by_truth[-1]) == {CL.NOISE}                 # small blob and scatter are noise
    sizes = Counter(r.cluster for r in out if r.cluster != CL.NOISE)
    assert all(v >= 20 for v in sizes.values())
    assert sorted(sizes) == [0, 1, 2]


def test_density_clusters_independent_of_partitioning(spark):
    a = {r.id: r.cluster for r in CL.density_clusters(_blobs(spark, 1)).collect()}
    b = {r.id: r.cluster for r in CL.density_clusters(_blobs(spark, 5)).collect()}
    assert a == b


def test_unequal_density_is_separated(spark):
    """A tight blob, a wide one, a bridge-free gap and thin background noise."""
    rnd = random.Random(4)
    pts = [(rnd.gauss(0, 0.2), rnd.gauss(0, 0.2), 0) for _ in range(600)]
    pts += [(rnd.gauss(8, 1.2), rnd.gauss(0, 1.2), 1) for _ in range(600)]
    pts += [(rnd.uniform(-10, 20), rnd.uniform(-15, 15), -1) for _ in range(60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "id long, x double, y double, truth int")
    seen = Counter((r.truth, r.cluster) for r in CL.density_clusters(df, min_cluster_size=60).collect())
    tight = max((n, c) for (t, c), n in seen.items() if t == 0)[1]
    wide = max((n, c) for (t, c), n in seen.items() if t == 1)[1]
    assert tight != wide and CL.NOISE not in (tight, wide)
    assert seen[0, tight] >= 560 and seen[1, wide] >= 400 and seen[-1, CL.NOISE] >= 25


def test_cell_clusters_choose_by_stability():
    peak = {(x, 0): n for x, n in enumerate([30, 50, 30, 2, 30, 50, 30])}
    two = CL.cell_clusters(peak, 20)
    assert two[1, 0] != two[5, 0] and (3, 0) not in two
    flat = {(x, 0): n for x, n in enumerate([30, 31, 30, 29, 30, 31, 30])}
    assert len(set(CL.cell_clusters(flat, 100).values())) == 1
    assert CL.cell_clusters({(0, 0): 5, (9, 9): 7}, 20) == {}
    assert CL.cell_clusters({}, 20) == {}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "cluster int, genres string, artist_name string")


def test_label_rules(spark):
    rows = [
        (0, "pop", "A"), (0, "pop", "A"), (0, "pop", "B"),                       # only 'pop'
        (1, "Pop, indie", "C"), (1, "indie, rock", "C"), (1, "rock", "D"),       # capitalised Pop
        (2, None, None),                                                          # nothing at all
        (3, None, "E"),                                                           # no genres
        (4, "jazz", None),                                                        # no artists
        (5, "a, b, c, d, e", "F"), (5, "e, d", "G"), (5, "e", "G"),               # > 4 genres, ties
        (-1, "pop", "Z"),
    ]
    got = dict((r.cluster, r.cluster_label) for r in CL.label_clusters(_frame(spark, rows)).collect())
    assert got[0] == "pop (A, B)"
    assert got[1] == "indie/rock/pop (C, D)"
    assert got[2] == "Cluster 2"
    assert got[3] == "(E)"
    assert got[4] == "jazz"
    assert got[5] == "e/d (G, F)"
    assert got[-1] == "Noise / Unclassified"


def test_cluster_summary_and_silhouette(spark):
    df = _blobs(spark).withColumn("features", F.array("x", "y"))
    s = {r.cluster: (r.size, r.share_pct, r.is_noise) for r in CL.cluster_summary(df, "truth").collect()}
    assert s[-1][2] is True and s[0][0] == 40 and abs(sum(v[1] for v in s.values()) - 100) < 0.01
    sil = CL.silhouette(df, "features", "truth").first()[0]
    assert 0.8 < sil <= 1.0


def test_recommend_for_random_roles(spark):
    df = CL.density_clusters(_blobs(spark)).withColumnRenamed("id", "track_id")
    out = RC.recommend_for_random(df, n=5, seed=1, cols=("x", "y")).collect()
    roles = Counter(r.role for r in out)
    assert roles == {"target": 1, "recommendation": 5, "background": len(out) - 6}
    target = [r for r in out if r.role == "target"][0]
    assert target.cluster != CL.NOISE
    recs = sorted(r.distance for r in out if r.role == "recommendation")
    others = [r.distance for r in out if r.role == "background"]
    assert max(recs) <= min(others)


def test_export_round_trip(spark, tmp_path):
    df = CL.attach_labels(CL.density_clusters(_blobs(spark)).withColumn(
        "genres", F.lit("rock")).withColumn("artist_name", F.lit("A")))
    RC.export_clusters(df, str(tmp_path / "out"))
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert back.count() == df.count() and "cluster_label" in back.columns


def test_pca_layout_matches_numpy(spark, small_model):
    import numpy as np
    from playstats.operators.layout import pca_layout
    from playstats.plans.features import feature_matrix
    fm = feature_matrix(small_model)
    laid = {r.track_id: (r.x, r.y) for r in pca_layout(fm).select("track_id", "x", "y").collect()}
    rows = sorted((r.track_id, r.features) for r in fm.select("track_id", "features").collect())
    X = np.array([f for _, f in rows], dtype=float)
    X = X / np.linalg.norm(X, axis=1, keepdims=True)
    cov = np.cov(X, rowvar=False)
    vals, vecs = np.linalg.eigh(cov)
    pc = vecs[:, np.argsort(vals)[::-1][:2]]
    for j in range(2):
        if pc[np.abs(pc[:, j]).argmax(), j] < 0:
            pc[:, j] *= -1
    proj = X @ pc
    for (tid, _), (x, y) in zip(rows, proj):
        assert abs(laid[tid][0] - x) < 1e-6 and abs(laid[tid][1] - y) < 1e-6


def test_points_get_the_cluster_of_their_cell(spark, small_model):
    import numpy as np
    from playstats.operators.layout import pca_layout
    from playstats.plans.features import feature_matrix
    laid = pca_layout(feature_matrix(small_model)).select("track_id", "x", "y")
    got = {r.track_id: (r.x, r.y, r.cluster) for r in CL.density_clusters(laid).collect()}
    xy = np.array([v[:2] for v in got.values()])
    sigma = np.sqrt((xy.var(axis=0)).mean())
    side = max(sigma * len(xy) ** -0.25, 2 * CL.REACH * sigma / CL.GRID)
    cell = np.clip(np.floor((xy - xy.mean(axis=0)) / side) + CL.GRID // 2, 0, CL.GRID - 1).astype(int)
    want = CL.cell_clusters(Counter(map(tuple, cell.tolist())), 20)
    agree = [want.get(tuple(c), CL.NOISE) == v[2] for c, v in zip(cell.tolist(), got.values())]
    assert np.mean(agree) >= 0.99     # a point on an edge may fall either way


def test_recommendations_match_brute_force(spark, small_model):
    import numpy as np
    from playstats.operators.layout import pca_layout
    from playstats.plans.features import FEATURE_COLS, feature_matrix
    fm = feature_matrix(small_model)
    laid = pca_layout(fm).drop("features")
    for frame, cols, fn in ((laid, ("x", "y"), RC.recommend_by_position),
                            (fm.drop("features"), FEATURE_COLS, RC.recommend_by_feature)):
        rows = sorted((r.track_id, [float(r[c]) for c in cols]) for r in frame.collect())
        ids = np.array([t for t, _ in rows])
        X = np.array([v for _, v in rows])
        d = np.sqrt(((X - X[0]) ** 2).sum(axis=1))
        order = sorted((round(float(dd), 9), int(t)) for t, dd in zip(ids[1:], d[1:]))[:5]
        got = [(round(r.distance, 9), r.track_id) for r in fn(frame, None, n=5).collect()]
        assert sorted(got) == order
