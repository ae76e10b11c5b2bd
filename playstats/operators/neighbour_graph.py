"""The weighted neighbour graph of a layout (M2, M3), after McInnes, Healy and Melville (2018).

*Graph.* The k nearest rows of every row are its directed edges (exact, from :mod:`knn`).

*Weights.* A row's nearest positive distance rho gets weight 1; a neighbour at distance d gets
``exp(-max(0, d - rho) / sigma)``, with sigma solved for each row so that its weights sum to log2 k. In 1 / sigma the sum
is convex and falls, so Newton's steps from an upper bound of sigma never pass the root; they end when one is below
``SETTLED`` of the value, as the next error is about its square. A row that has not settled after ``STEPS`` of them is bisected:
``STEPS`` halvings of an interval that is known to hold the root. Both are one ``aggregate`` over a row's k distances
inside the plan (JVM code, no Python).

*Symmetry.* The two directions a and b of a pair become ``a + b - a b``: a pair's edges are grouped by its smaller and
larger row, so each edge is shuffled once. A row's neighbours travel as one list, with which its sigma is found.

Defined results. sigma is at least ``FLOOR`` times the row's mean distance. Where so many neighbours lie
within rho that their weights alone pass log2 k, no sigma reaches the sum and the floor stands. A row
whose distances are all 0 or that has fewer than two neighbours gets weight 1 throughout.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.operators.knn import all_pairs_topk

STEPS = 64
FLOOR = 1e-3
SETTLED = 1e-9


def knn_graph(points: DataFrame, k: int = 30, id_col: str = "track_id", vector_col: str = "features",
              metric: str = "cosine") -> DataFrame:
    """M2: edges (src, dst, dist) to the k nearest rows of every row."""
    near = all_pairs_topk(points, k, id_col, vector_col, metric)
    return near.select(F.col("id").alias("src"), F.col("neighbour_id").alias("dst"), F.col("distance").alias("dist"))


def _scaled(edges: DataFrame, k: int) -> DataFrame:
    """(src, near, rho, sigma) of every row; each holds its k edges (dst, dist), no more."""
    if k < 2:
        raise ValueError("k must be at least 2")
    zero, target = F.lit(0.0), math.log2(k)
    nodes = edges.groupBy("src").agg(F.collect_list(F.struct("dst", "dist")).alias("near"),
                                     F.avg(F.greatest(F.col("dist"), zero)).alias("mean"))
    nodes = nodes.withColumn("ds", F.array_sort(F.transform("near", lambda e: F.greatest(e["dist"], zero))))
    nodes = nodes.withColumn("rho", F.coalesce(F.array_min(F.filter("ds", lambda x: x > 0)), zero))
    nodes = nodes.withColumn("over", F.transform("ds", lambda x: F.greatest(x - F.col("rho"), zero)))
    # every term is at least log2 k / k at this sigma, so the sum of k terms has passed log2 k
    nodes = nodes.withColumn("top", F.array_max("over") / math.log(k / target))

    def total(sigma):
        return F.aggregate("over", zero, lambda a, x: a + F.when(x > 0, F.exp(-x / F.nullif(sigma, zero))).otherwise(1.0))

    def halve(s, _):
        mid = (s["lo"] + s["hi"]) / 2
        low = F.coalesce(total(mid), zero) < target
        return F.struct(F.when(low, mid).otherwise(s["lo"]).alias("lo"), F.when(low, s["hi"]).otherwise(mid).alias("hi"))

    nodes = nodes.withColumn("far", F.filter("over", lambda x: x > 0))
    nodes = nodes.withColumn("within", (F.size("over") - F.size("far")).cast("double"))       # weights of 1 whatever sigma is

    def sums(u):
        return F.struct(F.aggregate("far", F.col("within"), lambda a, x: a + F.exp(-x * u)).alias("sum"),
                        F.aggregate("far", zero, lambda a, x: a + x * F.exp(-x * u)).alias("fall"))

    def step(s):
        def moved(t):
            on = (t["sum"] - target) / F.nullif(t["fall"], zero)
            return F.when(t["sum"] <= target, F.struct(s["u"].alias("u"), F.lit(True).alias("settled"))).otherwise(
                F.struct((s["u"] + F.coalesce(on, zero)).alias("u"), F.coalesce(on <= s["u"] * SETTLED, F.lit(False)).alias("settled")))

        return F.transform(F.array(sums(s["u"])), moved)[0]      # the sums are bound once

    begin = F.struct((1 / F.nullif("top", zero)).alias("u"), F.lit(False).alias("settled"))
    newton = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), begin, lambda s, _: F.when(s["settled"], s).otherwise(step(s)))
    start = F.struct(zero.alias("lo"), F.col("top").alias("hi"))
    halved = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve)["hi"]
    nodes = nodes.withColumn("newton", F.when((F.col("top") > 0) & (F.col("within") < target), newton))
    found = F.when(F.col("newton").isNull(), zero).when(F.col("newton")["settled"], 1 / F.col("newton")["u"]).otherwise(halved)
    return nodes.select("src", "near", "rho", F.greatest(found, F.col("mean") * FLOOR).alias("sigma"))


def node_scales(edges: DataFrame, k: int) -> DataFrame:
    """(src, rho, sigma) of every row."""
    return _scaled(edges, k).drop("near")


def directed_weights(edges: DataFrame, k: int) -> DataFrame:
    """(src, dst, weight) before symmetrising."""
    over = F.greatest(F.col("dist") - F.col("rho"), F.lit(0.0))
    weight = F.when(over > 0, F.exp(-over / F.col("sigma"))).otherwise(1.0)
    return _scaled(edges, k).select("src", "rho", "sigma", F.inline("near")).select("src", "dst", weight.alias("weight"))


def neighbour_weights(edges: DataFrame, k: int) -> DataFrame:
    """M3: symmetric edges (src, dst, weight), both directions of each pair."""
    src, dst = F.col("src"), F.col("dst")
    pairs = directed_weights(edges, k).groupBy(F.least(src, dst).alias("low"), F.greatest(src, dst).alias("high")).agg(
        F.coalesce(F.max(F.when(src <= dst, F.col("weight"))), F.lit(0.0)).alias("a"),
        F.coalesce(F.max(F.when(src >= dst, F.col("weight"))), F.lit(0.0)).alias("b"))
    ways = F.array_distinct(F.array(F.struct(F.col("low").alias("src"), F.col("high").alias("dst")),
                                    F.struct(F.col("high").alias("src"), F.col("low").alias("dst"))))
    a, b = F.col("a"), F.col("b")
    return pairs.select(F.inline(ways), (a + b - a * b).alias("weight"))
