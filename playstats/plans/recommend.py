"""Track similarity and recommendations."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.model import Model
from playstats.operators.knn import all_pairs_topk
from playstats.operators.similarity import (cosine_to_target, drop_target_cols,
                                            euclidean_to_target)
from playstats.session import cut_lineage
from playstats.plans.features import (DEFAULT_AS_OF, FEATURE_COLS, clean_from_engineered, feature_matrix,
                                      track_features_engineered)

# Column order of the similarity SQL's target vector (skip_low before skip_never).
SIMILARITY_COLS = FEATURE_COLS


def clean_with_names(m: Model, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    # The scaled rows with their names, stored once: target and candidates are read from them.
    return cut_lineage(clean_from_engineered(track_features_engineered(m, as_of),
                                             carry=("title", "artist", "genres", "total_plays")))


def similar_tracks_to(candidates: DataFrame, target: DataFrame, n: int = 10) -> DataFrame:
    """S1 core: top n by cosine similarity to a one-row target.

    Ordered by the similarity rounded to 9 places, then track_id, so last-bit
    differences cannot change which rows make the cut.
    """
    scored = cosine_to_target(candidates, target, SIMILARITY_COLS)
    return (scored.orderBy(F.round("cosine_similarity", 9).desc(), "track_id").limit(n)
            .select("title", "artist", "genres", "cosine_similarity"))


def similar_tracks(m: Model, title: str, artist: str, n: int = 10,
                   as_of: _dt.date = DEFAULT_AS_OF, cand: DataFrame | None = None) -> DataFrame:
    """The n tracks most similar to the track named (title, artist).

    (title, artist) is unique in a loaded model; if it is not, the lowest track_id
    is the target, so the broadcast side is always one row. ``cand``: the stored rows of
    :func:`clean_with_names`, if the caller has them.
    """
    cand = clean_with_names(m, as_of) if cand is None else cand
    target = (cand.filter((F.col("title") == title) & (F.col("artist") == artist))
              .orderBy("track_id").limit(1))
    return similar_tracks_to(cand, target, n)


def similar_to_most_played(m: Model, n: int = 10, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """S1 with the most played track (ties: lowest track_id) as target."""
    cand = clean_with_names(m, as_of)
    target = cand.orderBy(F.col("total_plays").desc(), "track_id").limit(1)
    return similar_tracks_to(cand, target, n)


def similar_artists(m: Model, n: int = 10, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """S5 on artists: fills (artist_id, similar_artist_id, similarity_score).

    An artist is the mean of its tracks' feature rows; the score is the cosine similarity to the n
    most similar other artists. Artists without a complete feature row, or whose mean is zero, have none.
    """
    fm = feature_matrix(m, as_of, with_vector=False).join(m.tracks.select("track_id", "artist_id"), "track_id")
    means = fm.groupBy("artist_id").agg(F.array(*[F.avg(c) for c in FEATURE_COLS]).alias("vector"))
    near = all_pairs_topk(means, n, "artist_id", "vector")
    return near.select(F.col("id").alias("artist_id"), F.col("neighbour_id").alias("similar_artist_id"),
                       (1 - F.col("distance")).alias("similarity_score"))


def recommend_by_feature(fm: DataFrame, track_id: int | None = None, n: int = 5,
                         cols=FEATURE_COLS) -> DataFrame:
    """N nearest tracks by Euclidean distance over ``cols`` of the feature matrix.

    The target is excluded by id; an unknown id gives an empty frame. With
    ``track_id=None`` the lowest track_id is the target.
    """
    fm = cut_lineage(fm)  # read twice: target and candidates
    target = fm.filter(F.col("track_id") == track_id) if track_id is not None else fm
    target = target.orderBy("track_id").limit(1)
    scored = euclidean_to_target(fm, target, cols)
    return drop_target_cols(scored.orderBy(F.round("distance", 9), "track_id").limit(n),
                            cols, "track_id")


def recommend_by_position(layout: DataFrame, track_id: int | None = None, n: int = 5) -> DataFrame:
    """S3: n nearest tracks in the 2-D layout (columns x, y)."""
    return recommend_by_feature(layout, track_id, n, cols=("x", "y"))


def recommend_for_random(frame: DataFrame, n: int = 5, seed: int = 42,
                         cols=FEATURE_COLS) -> DataFrame:
    """Pick a reproducible 'random' non-noise track, return target, recs, background.

    The pick is the smallest ``xxhash64(track_id, seed)`` among rows whose cluster
    is not -1 (all rows if every row is noise): one global min, no sampling pass.
    Output: every row of ``frame`` with ``distance`` and ``role`` in
    {'target', 'recommendation', 'background'}.
    """
    frame = cut_lineage(frame)   # read for the pick, the target and the scores
    h = frame.withColumn("_h", F.xxhash64("track_id", F.lit(seed)))
    non_noise = h.filter(F.col("cluster") != -1) if "cluster" in frame.columns else h
    pick = non_noise.select(F.min(F.struct("_h", "track_id")).alias("_p"))
    fallback = h.select(F.min(F.struct("_h", "track_id")).alias("_q"))
    chosen = (pick.crossJoin(fallback)
              .select(F.coalesce(F.col("_p.track_id"), F.col("_q.track_id")).alias("_target")))
    target = h.join(F.broadcast(chosen), F.col("track_id") == F.col("_target")).drop("_target", "_h")
    t = target.select(F.col("track_id").alias("t_track_id"), *[F.col(c).alias(f"t_{c}") for c in cols])
    from playstats.operators.similarity import sq_dist
    scored = (h.drop("_h").crossJoin(F.broadcast(t.limit(1)))
              .withColumn("distance", F.sqrt(sq_dist(cols))))
    recs = (scored.filter(F.col("track_id") != F.col("t_track_id"))
            .orderBy(F.round("distance", 9), "track_id").limit(n)
            .select("track_id", F.lit("recommendation").alias("_role")))
    out = (scored.join(F.broadcast(recs), "track_id", "left")
           .withColumn("role", F.when(F.col("track_id") == F.col("t_track_id"), F.lit("target"))
                       .otherwise(F.coalesce(F.col("_role"), F.lit("background"))))
           .drop("_role"))
    return drop_target_cols(out, cols, "track_id")


def cluster_tracks(m: Model, min_cluster_size: int = 20, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """The recommender frame: feature matrix + 2-D layout + density cluster + label."""
    from playstats.operators.clusters import attach_labels, density_clusters
    from playstats.operators.layout import pca_layout
    from playstats.plans.features import feature_matrix
    laid = pca_layout(feature_matrix(m, as_of))
    # stored once: the labels read it several times
    clustered = cut_lineage(density_clusters(laid, "x", "y", min_cluster_size=min_cluster_size))
    return attach_labels(clustered, "cluster")


def export_clusters(frame: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write the clustered tracks (array column flattened away) with a header."""
    out = frame.drop("features")
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
