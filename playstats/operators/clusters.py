"""Density clustering of 2-D points, cluster labels, summary, silhouette (M5-M8).

Density clustering (re-aim of the reference's single-machine hierarchical density
clustering, same contract: ``cluster`` id per point, -1 = noise, clusters of at
least ``min_cluster_size`` points), over a grid instead of point pairs:

1. one global aggregate gives n, the means and the spread; the grid has a side of
   sigma * n^(-1/4), and at most ``GRID`` cells an axis (points beyond six sigma lie in
   the outermost cells), so it has at most GRID^2 cells whatever n is;
2. points are counted per cell (hash aggregate with map-side combine, so a cell that
   holds a third of all points is one row after the partial step). This bounded table of
   counts is all that reaches the driver;
3. the hierarchy: cells enter in the order of their smoothed density and join the
   components of their 8 neighbours; a component of ``min_cluster_size`` points is a cluster,
   and two clusters that meet become the children of a new one;
4. clusters are chosen by stability, the excess of density over the level at which a cluster
   meets another, summed over its points: a parent that is more stable than its chosen
   children replaces them. All cells of no chosen cluster are noise;
5. the chosen cells (bounded as above) are joined to the points by broadcast.
"""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstats.functions.exprs import num_round

NOISE = -1
NOISE_LABEL = "Noise / Unclassified"
GRID = 256          # cells an axis, at most
REACH = 6.0         # the grid spans so many sigma to each side of the mean


def grid_cells(points: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Add integer grid coordinates ``_cx``, ``_cy`` in 0..GRID-1."""
    n, mx, my, vx, vy = points.agg(F.count(F.lit(1)), F.avg(x), F.avg(y), F.var_pop(x), F.var_pop(y)).first()
    sigma = (((vx or 0.0) + (vy or 0.0)) / 2) ** 0.5
    side = max(sigma * max(n, 1) ** -0.25, 2 * REACH * sigma / GRID) or 1.0

    def cell(c: str, mean: float | None):
        i = F.floor((F.col(c) - F.lit(mean or 0.0)) / F.lit(side)) + GRID // 2
        return F.least(F.greatest(i, F.lit(0)), F.lit(GRID - 1)).cast("int")

    return points.withColumns({"_cx": cell(x, mx), "_cy": cell(y, my)})


def _around(c: tuple[int, int]):
    return [(c[0] + dx, c[1] + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1) if dx or dy]


def cell_clusters(counts: dict[tuple[int, int], int], min_cluster_size: int) -> dict[tuple[int, int], int]:
    """Cell -> cluster number (by descending size) of the cells in a chosen cluster."""
    weight = {0: 4, 1: 2, 2: 1}
    density = {c: (4 * n + sum(weight[abs(o[0] - c[0]) + abs(o[1] - c[1])] * counts.get(o, 0)
                               for o in _around(c))) / 16 for c, n in counts.items()}
    root: dict[tuple[int, int], tuple[int, int]] = {}

    def find(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    size: dict[tuple[int, int], int] = {}
    loose: dict[tuple[int, int], list] = {}          # cells of a component that is no cluster yet
    node: dict[tuple[int, int], int] = {}            # component -> its cluster
    excess, weightof, kids, cells = [], [], [], []   # by cluster

    def add(k: int, cs: list, level: float) -> None:
        cells[k] += cs
        n = sum(counts[c] for c in cs)
        excess[k] += n * level
        weightof[k] += n

    def new(children: list[int], level: float) -> int:
        excess.append(0.0)
        weightof.append(0)
        kids.append(children)
        cells.append([])
        for k in children:                           # they end here, and their points go on in the parent
            excess[-1] += weightof[k] * level
            weightof[-1] += weightof[k]
            excess[k] -= weightof[k] * level
        return len(excess) - 1

    for c in sorted(counts, key=lambda c: (-density[c], c)):
        level = density[c]
        root[c], size[c], loose[c] = c, counts[c], [c]
        parts = {find(o) for o in _around(c) if o in root} | {c}
        top = min(parts, key=lambda r: (-size[r], r))
        held = sorted({node[r] for r in parts if r in node})
        free = [x for r in parts for x in loose.pop(r, [])]
        total = sum(size[r] for r in parts)
        for r in parts:
            root[r] = top
            node.pop(r, None)
        size[top] = total
        if len(held) > 1:
            node[top] = new(held, level)
        elif held:
            node[top] = held[0]
        elif total >= min_cluster_size:
            node[top] = new([], level)
        if top in node:
            add(node[top], free, level)
        else:
            loose[top] = free
    tops = set(node.values())
    best, chosen = [0.0] * len(excess), [True] * len(excess)
    for k in range(len(excess)):                     # children come before parents
        below = sum(best[j] for j in kids[k])
        alone = k in tops and len(tops) == 1 and kids[k]      # the whole is no cluster if it has parts
        chosen[k] = not kids[k] or (excess[k] >= below and not alone)
        best[k] = excess[k] if chosen[k] else below
    picked, stack = [], list(tops)
    while stack:
        k = stack.pop()
        if chosen[k]:
            inside, todo = [], [k]
            while todo:
                j = todo.pop()
                inside += cells[j]
                todo += kids[j]
            picked.append(inside)
        else:
            stack += kids[k]
    picked.sort(key=lambda cs: (-sum(counts[c] for c in cs), min(cs)))
    return {c: i for i, cs in enumerate(picked) for c in cs}


def density_clusters(points: DataFrame, x: str = "x", y: str = "y", min_cluster_size: int = 20) -> DataFrame:
    """Add ``cluster`` (0.. by descending size, -1 = noise) to every point."""
    pts = grid_cells(points, x, y)
    counts = {(r["_cx"], r["_cy"]): r["n"] for r in
              pts.groupBy("_cx", "_cy").agg(F.count(F.lit(1)).alias("n")).collect()}    # at most GRID^2 rows
    counts = {c: n for c, n in counts.items() if None not in c}
    found = [(*c, k) for c, k in sorted(cell_clusters(counts, min_cluster_size).items())]
    table = points.sparkSession.createDataFrame(found, "_gx int, _gy int, cluster int")
    return (pts.join(F.broadcast(table), (F.col("_cx") == F.col("_gx")) & (F.col("_cy") == F.col("_gy")), "left")
            .withColumn("cluster", F.coalesce(F.col("cluster"), F.lit(NOISE)))
            .drop("_cx", "_cy", "_gx", "_gy"))


def cluster_summary(df: DataFrame, cluster_col: str = "cluster") -> DataFrame:
    """M6: per cluster: size, share of all rows in percent (3 places), noise flag."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    sizes = df.groupBy(F.col(cluster_col).cast("int").alias("cluster")).agg(
        F.count(F.lit(1)).alias("size"))
    return (sizes.crossJoin(F.broadcast(total))
            .select("cluster", "size",
                    num_round(F.col("size") * 100.0 / F.col("_total"), 3).alias("share_pct"),
                    (F.col("cluster") == NOISE).alias("is_noise")))


# The generic genre set and label limits of the cluster labels.
GENERIC_GENRES = ("pop",)
TOP_GENRES, KEEP_SUBGENRES, TOP_ARTISTS = 4, 2, 2


def label_clusters(df: DataFrame, cluster_col: str = "cluster", genres_col: str = "genres",
                   artist_col: str = "artist_name") -> DataFrame:
    """M7: one readable label per cluster, all clusters in one pass.

    Top 4 genres (genre lists split on ',' and trimmed; counts over rows; ties by
    name); up to 2 of them that are not generic, then 'pop' if a generic one was in
    the top 4, joined with '/'; then the 2 most frequent artists as '(A, B)'. With
    neither part the label is 'Cluster <id>'; -1 is 'Noise / Unclassified'.
    """
    cl = F.col(cluster_col).cast("int")
    g = (df.select(cl.alias("cluster"), F.explode(F.split(genres_col, ",")).alias("g"))
         .select("cluster", F.trim("g").alias("genre")))
    gc = g.groupBy("cluster", "genre").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("cluster").orderBy(F.col("n").desc(), "genre")
    top = gc.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= TOP_GENRES)
    is_generic = F.lower("genre").isin(*GENERIC_GENRES)
    sub = (top.filter(~is_generic)
           .withColumn("_s", F.row_number().over(Window.partitionBy("cluster").orderBy("_r")))
           .filter(F.col("_s") <= KEEP_SUBGENRES))
    # at most 2 items per cluster are collected: bounded
    sub_list = sub.groupBy("cluster").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_s", "genre"))),
                                 lambda s: s.getField("genre")), "/").alias("_subs"))
    generic = top.groupBy("cluster").agg(F.max(is_generic.cast("int")).alias("_has_generic"))
    genre_part = (generic.join(sub_list, "cluster", "left").select(
        "cluster",
        F.when(F.col("_has_generic") == 1,
               F.when(F.col("_subs").isNull() | (F.col("_subs") == ""), F.lit("pop"))
               .otherwise(F.concat(F.col("_subs"), F.lit("/pop"))))
        .otherwise(F.when(F.col("_subs") != "", F.col("_subs"))).alias("_genres")))
    a = (df.filter(F.col(artist_col).isNotNull())
         .groupBy(cl.alias("cluster"), F.col(artist_col).alias("artist"))
         .agg(F.count(F.lit(1)).alias("n")))
    wa = Window.partitionBy("cluster").orderBy(F.col("n").desc(), "artist")
    artists = (a.withColumn("_r", F.row_number().over(wa)).filter(F.col("_r") <= TOP_ARTISTS)
               .groupBy("cluster").agg(
                   F.concat(F.lit("("), F.array_join(F.transform(
                       F.array_sort(F.collect_list(F.struct("_r", "artist"))),
                       lambda s: s.getField("artist")), ", "), F.lit(")")).alias("_artists")))
    ids = df.select(cl.alias("cluster")).distinct()
    j = ids.join(genre_part, "cluster", "left").join(artists, "cluster", "left")
    text = F.concat_ws(" ", F.col("_genres"), F.col("_artists"))
    return j.select("cluster", F.when(F.col("cluster") == NOISE, F.lit(NOISE_LABEL))
                    .when(text == "", F.concat(F.lit("Cluster "), F.col("cluster").cast("string")))
                    .otherwise(text).alias("cluster_label"))


def attach_labels(df: DataFrame, cluster_col: str = "cluster", **kw) -> DataFrame:
    """Map every row's cluster to its label (join to the per-cluster label table)."""
    labels = label_clusters(df, cluster_col, **kw)
    return df.join(labels.withColumnRenamed("cluster", "_c"),
                   F.col(cluster_col).cast("int") == F.col("_c"), "left").drop("_c")


def silhouette(df: DataFrame, features_col: str, cluster_col: str = "cluster",
               exclude_noise: bool = True) -> DataFrame:
    """M8: mean silhouette (squared Euclidean) as a one-row frame; NULL below 2 clusters.

    Spark ML's evaluator aggregates per cluster, O(n * k), no pairwise distances.
    """
    spark = df.sparkSession
    d = df.filter(F.col(cluster_col) != NOISE) if exclude_noise else df
    d = d.select(array_to_vector(F.col(features_col).cast("array<double>")).alias("_f"),
                 F.col(cluster_col).cast("double").alias("_p"))
    k = d.select("_p").distinct().limit(2).count()
    value = None
    if k >= 2:
        value = float(ClusteringEvaluator(featuresCol="_f", predictionCol="_p",
                                          metricName="silhouette").evaluate(d))
    return spark.createDataFrame([(value,)], "silhouette double")
