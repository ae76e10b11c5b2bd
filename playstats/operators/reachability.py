"""Minimum spanning forest of the mutual-reachability distances (M5b), on which hierarchical density clustering stands.

The weight of a pair is the largest of its distance and of the two core distances. Boruvka rounds on tables:
each component takes its lightest edge to another one, and components joined by these edges merge, so
their number at least halves a round.

No round forms all pairs. Points lie in the cells of about sqrt(n) pivots, each with its bounding box and its
range of core distances. For the points of a component in a cell, a cell that holds points of other components bounds
the lightest edge from above by the farthest corners of the boxes; the least such bound of a component is its reach. Its
points then visit only cells within that reach, and no cell that lies in their own component as a whole,
so the inside of a large component costs nothing. Cells are cut into blocks and visitors into portions, as in
:mod:`playstats.operators.knn`; of a round the driver sees one row a cell (at most ``MAX_PIVOTS``).

Weights are compared at 9 places, then by ids (smaller, larger), so the edges of distinct points are the same in
every run. Points with equal coordinates are one while searching; the others of them hang on the one with the smallest
id, at their common core distance. Points with a null or non-finite coordinate or without id take no part; points that
repeat an id count once (the smallest). Fewer than two points give no edge.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.operators.density import core_distances
from playstats.operators.knn import PLACES, TIE, _distances, _pivots, usable_vectors
from playstats.session import cut_lineage

BLOCK = 2048
_EDGE = "comp long, weight double, a long, b long, other long"


def _deal(classes: DataFrame, n: int) -> DataFrame:
    """``classes`` (id, x, y, core) with the cell of the nearest pivot."""
    pivots = _pivots(classes.select(F.col("id").alias("rep"), F.array("x", "y").alias("vec"), F.lit(1.0).alias("length")), n)

    def deal(frames):
        for pdf in frames:
            if len(pdf):
                yield pdf.assign(cell=_distances(pdf[["x", "y"]].to_numpy(), pivots).argmin(axis=1).astype(np.int32))

    return cut_lineage(classes.mapInPandas(deal, "id long, x double, y double, core double, cell int"))


def _boxes(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min("core").alias("near"), F.max("core").alias("far"), F.min("comp").alias("first"), F.max("comp").alias("last"))


def _span(g: pd.DataFrame, c: pd.DataFrame, axis: str) -> tuple[np.ndarray, np.ndarray]:
    """(gap, reach) along an axis between the boxes of each row of ``g`` and each of ``c``."""
    (g0, g1), (c0, c1) = (tuple(t[f"{axis}{i}"].to_numpy() for i in (0, 1)) for t in (g, c))
    a, b = c0[None, :] - g1[:, None], g0[:, None] - c1[None, :]
    return np.maximum(np.maximum(a, b), 0), np.maximum(c1[None, :] - g0[:, None], g1[:, None] - c0[None, :])


def _lightest(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
    """The lightest edge from each component of ``q`` to a point of ``c`` in another one."""
    none = pd.DataFrame({"comp": pd.Series(dtype="int64"), "weight": pd.Series(dtype="float64"), "a": pd.Series(dtype="int64"),
                         "b": pd.Series(dtype="int64"), "other": pd.Series(dtype="int64")})
    if not len(q) or not len(c):
        return none
    d = np.hypot(q["x"].to_numpy()[:, None] - c["x"].to_numpy()[None, :], q["y"].to_numpy()[:, None] - c["y"].to_numpy()[None, :])
    w = np.round(np.maximum(np.maximum(d, q["core"].to_numpy()[:, None]), c["core"].to_numpy()[None, :]), PLACES)
    comp, other = q["comp"].to_numpy(), c["comp"].to_numpy()
    w[comp[:, None] == other[None, :]] = np.inf
    row = pd.Series(w.min(axis=1))
    best = row.groupby(comp).transform("min").to_numpy()
    at = np.nonzero(np.isfinite(best) & (row.to_numpy() == best))[0]
    i, j = np.nonzero(w[at] == best[at, None])
    i = at[i]
    p, o = q["id"].to_numpy()[i], c["id"].to_numpy()[j]
    out = pd.DataFrame({"comp": comp[i], "weight": w[i, j], "a": np.minimum(p, o), "b": np.maximum(p, o), "other": other[j]})
    return out.sort_values(["comp", "a", "b"]).drop_duplicates("comp")


def _round(state: DataFrame, groups: DataFrame, cells: pd.DataFrame) -> DataFrame:
    """(comp, weight, a, b, other): the lightest edge of every component of ``state`` (id, x, y, core, cell, comp)."""
    def reach(frames):
        for g in frames:
            if len(g):
                (_, dx), (_, dy) = _span(g, cells, "x"), _span(g, cells, "y")
                most = np.maximum(np.maximum(np.hypot(dx, dy), g["far"].to_numpy()[:, None]), cells["far"].to_numpy()[None, :])
                comp = g["comp"].to_numpy()[:, None]
                own = (cells["first"].to_numpy()[None, :] == comp) & (cells["last"].to_numpy()[None, :] == comp)
                most[own] = np.inf
                yield pd.DataFrame({"comp": g["comp"], "reach": most.min(axis=1)})

    def visit(frames):
        for g in frames:
            if len(g):
                (dx, _), (dy, _) = _span(g, cells, "x"), _span(g, cells, "y")
                least = np.maximum(np.maximum(np.hypot(dx, dy), g["near"].to_numpy()[:, None]), cells["near"].to_numpy()[None, :])
                comp = g["comp"].to_numpy()[:, None]
                own = (cells["first"].to_numpy()[None, :] == comp) & (cells["last"].to_numpy()[None, :] == comp)
                need = (least <= g["reach"].to_numpy()[:, None] * (1 + 1e-12) + TIE) & ~own
                i, j = np.nonzero(need)
                yield pd.DataFrame({"cell": g["cell"].to_numpy()[i], "comp": g["comp"].to_numpy()[i], "n": g["n"].to_numpy()[i],
                                    "reach": g["reach"].to_numpy()[i], "to": cells["cell"].to_numpy()[j]})

    reaches = groups.mapInPandas(reach, "comp long, reach double").groupBy("comp").agg(F.min("reach").alias("reach"))
    visits = cut_lineage(groups.join(reaches, "comp").mapInPandas(visit, "cell int, comp long, n long, reach double, to int"))
    coming = {r["to"]: r["n"] for r in visits.groupBy("to").agg(F.sum("n").alias("n")).collect()}       # a row a cell
    table = [(int(c), -(-int(n) // BLOCK), -(-coming[c] // BLOCK)) for c, n in zip(cells["cell"], cells["n"]) if c in coming]
    cuts = F.broadcast(state.sparkSession.createDataFrame(table, "to int, blocks int, portions int"))
    far = F.col("reach") * (1 + 1e-12) + TIE
    asking = (state.join(visits.drop("n"), ["cell", "comp"]).filter(F.col("core") <= far).join(cuts, "to")
              .withColumn("portion", F.pmod(F.xxhash64("id", F.lit(3)), "portions").cast("int"))
              .select("to", "portion", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "id", "x", "y", "core", "comp"))
    asked = (state.withColumnRenamed("cell", "to").join(cuts, "to")
             .withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
             .select("to", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)).alias("portion"), "block",
                     *[F.col(c).alias(c) for c in ("id", "x", "y", "core", "comp")]))       # both sides read the same table
    key = ["to", "portion", "block"]
    found = asking.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(_lightest, _EDGE)
    return cut_lineage(found.groupBy("comp").agg(F.min(F.struct("weight", "a", "b", "other")).alias("e")).select("comp", "e.*"))


def _merged(chosen: DataFrame) -> DataFrame:
    """(comp, root) of components that point at each other by their lightest edges: pointer doubling."""
    to = chosen.select(F.col("comp").alias("_c"), F.col("other").alias("_o"))
    mutual = (F.col("_o") == F.col("comp")) & (F.col("comp") < F.col("other"))
    links = cut_lineage(chosen.join(to, F.col("other") == F.col("_c")).select(
        "comp", F.when(mutual, F.col("comp")).otherwise(F.col("other")).alias("root")))
    while True:
        on = links.select(F.col("comp").alias("_c"), F.col("root").alias("_r"))
        links = cut_lineage(links.join(on, F.col("root") == F.col("_c")).select(
            "comp", F.col("_r").alias("root"), (F.col("_r") != F.col("root")).alias("moved")))
        if not links.filter("moved").limit(1).count():
            return links.select("comp", "root")
        links = links.drop("moved")


def mutual_reachability_forest(points: DataFrame, k: int = 20, x: str = "x", y: str = "y", id_col: str = "track_id") -> DataFrame:
    """(a, b, weight): the n - 1 edges, a < b, of the minimum spanning tree of the points, ``k`` as in core_distances."""
    placed = points.select(F.col(id_col).cast("long").alias("id"), F.array(F.col(x).cast("double"), F.col(y).cast("double")).alias("at"))
    used = usable_vectors(cut_lineage(placed), "id", "at", "l2")
    cores = core_distances(used.select("id", F.col("vec")[0].alias("x"), F.col("vec")[1].alias("y")), k, "x", "y", "id")
    used = cut_lineage(used.join(cores, "id").select("id", (F.col("vec")[0] + 0.0).alias("x"), (F.col("vec")[1] + 0.0).alias("y"), "core"))
    classes = cut_lineage(used.groupBy("x", "y").agg(F.min("id").alias("id"), F.min("core").alias("core")).select("id", "x", "y", "core"))
    same = classes.select("x", "y", F.col("id").alias("a"), F.round("core", PLACES).alias("weight"))
    edges = [used.select("x", "y", F.col("id").alias("b")).join(same, ["x", "y"]).filter("a < b").select("a", "b", "weight")]
    n = classes.count()
    if n > 1:
        state = _deal(classes, n).withColumn("comp", F.col("id"))
        while True:
            groups = cut_lineage(_boxes(state, "cell", "comp"))
            cells = (groups.groupBy("cell").agg(
                F.sum("n").alias("n"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"),
                F.min("near").alias("near"), F.max("far").alias("far"), F.min("first").alias("first"), F.max("last").alias("last"))
                .toPandas().sort_values("cell", ignore_index=True))        # a row a pivot
            if cells["first"].min() == cells["last"].max():
                break
            chosen = _round(state, groups, cells)
            edges.append(chosen.select("a", "b", "weight").distinct())
            state = cut_lineage(state.join(_merged(chosen), "comp").select("id", "x", "y", "core", "cell", F.col("root").alias("comp")))
    out = edges[0]
    for e in edges[1:]:
        out = out.unionByName(e)
    return out
