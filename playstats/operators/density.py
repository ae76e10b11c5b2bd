"""Core distances: how far a point's k-th neighbour lies (M5a), the density measure of hierarchical clustering.

Exact, by the cell join of :mod:`playstats.operators.knn`: a point visits its own cell and those that can
hold one of its k nearest, so sparse points reach as far as they need and no coordinate is clamped to a
grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.operators.knn import all_pairs_topk, usable_vectors
from playstats.session import cut_lineage


def core_distances(points: DataFrame, k: int = 20, x: str = "x", y: str = "y", id_col: str = "track_id") -> DataFrame:
    """(id_col, core): the Euclidean distance to the k-th nearest point, the point itself being the first.

    With fewer than k points it is the distance to the farthest; a single point has 0. Points with a null
    or non-finite coordinate take no part; points that repeat an id count once (the smallest).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    placed = cut_lineage(points.select(F.col(id_col).cast("long").alias("id"), F.array(F.col(x).cast("double"), F.col(y).cast("double")).alias("at")))
    every = usable_vectors(placed, "id", "at", "l2").select("id")
    far = all_pairs_topk(placed, max(1, k - 1), "id", "at", "l2").groupBy("id").agg(F.max("distance").alias("core"))
    core = F.coalesce("core", F.lit(0.0)) if k > 1 else F.lit(0.0)
    return every.join(far, "id", "left").select(F.col("id").alias(id_col), core.alias("core"))
