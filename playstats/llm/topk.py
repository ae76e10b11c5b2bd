"""Exact top-k inner products by pivot-table elimination.

Vectors are whole numbers, floor(1024 * x). The distances of every vector to the pivots (the
origin and 32 vectors) are computed once. For a query q and a candidate x each pivot p bounds
their distance from below by |d(q, p) - d(x, p)|; the largest bound gives
``q.x <= (|q|^2 + |x|^2 - bound^2) / 2``. A block's candidates are evaluated in the order of
these upper bounds until the k-th best score exceeds the next bound, which is exact. A bound is
widened by a relative 1e-9, far more than rounding can take from it.

Defined results. Null vectors, empty ones and those with null or non-finite components take no
part, as do rows without id; rows that repeat an id count once (smallest vector). Vectors
meet those of their own length. With fewer than k candidates all are returned. An empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import write_once
from playstats.llm.vectors import finite_vectors, search_blocks

PIVOTS = 32
SCALE = 1024


def _with_distances(vectors: DataFrame, pivots: list[list[int]]) -> DataFrame:
    """``vectors`` (vec_id, dim, vec) plus the distances to the origin and to the pivots of its length."""

    def distances(frames):
        for pdf in frames:
            out = []
            for v in pdf["vec"]:
                v = np.asarray(v, dtype=np.float64)
                near = [p for p in pivots if len(p) == len(v)]
                out.append([float(np.sqrt(v @ v)), *(float(np.sqrt(((v - p) ** 2).sum())) for p in near)])
            pdf["far"] = out
            yield pdf

    return vectors.mapInPandas(distances, "vec_id long, dim int, vec array<long>, far array<double>")


def _kernel(k: int):
    def search(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        ids = cs["vec_id"].to_numpy()
        x, far = np.stack(cs["vec"]).astype(np.int64), np.stack(cs["far"])
        out = []
        for qid, q, near in zip(qs["vec_id"], qs["vec"], qs["far"]):
            q = np.asarray(q, dtype=np.int64)
            low = np.abs(far - near).max(axis=1)                  # largest lower bound of the distance
            squares = near[0] ** 2 + far[:, 0] ** 2
            high = (squares - low ** 2) / 2 + 1e-9 * squares + 1e-6
            high[ids == qid] = -np.inf
            order = np.argsort(-high)
            order = order[:len(order) - int((ids == qid).sum())]
            best_s, best_i = np.empty(0, np.int64), np.empty(0, np.int64)
            at, step = 0, 512
            while at < len(order):
                if len(best_s) == k and best_s[-1] > high[order[at]]:
                    break                                          # no later candidate can tie
                rows = order[at:at + step]
                best_s = np.concatenate([best_s, x[rows] @ q])
                best_i = np.concatenate([best_i, ids[rows]])
                top = np.lexsort((best_i, -best_s))[:k]
                best_s, best_i = best_s[top], best_i[top]
                at, step = at + step, step * 2
            out.append(pd.DataFrame({"query_id": qid, "vec_id": best_i, "score": best_s}))
        return pd.concat(out, ignore_index=True)

    return search


def exact_top_k(table: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
                vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best for each row whose id is divisible by ``every``."""
    whole = finite_vectors(table, id_col, vector_col).select(
        "vec_id", F.size("vec").alias("dim"), F.transform("vec", lambda x: F.floor(x * SCALE)).alias("vec"))
    whole = write_once(whole, "topk-vectors")
    n = whole.count()
    # pivots: a bounded draw by hash, thinned before the ordering so that little reaches the driver
    share = F.xxhash64("vec_id").bitwiseAND(F.lit((1 << 62) - 1)) < int(min(1.0, 20 * pivots / max(1, n)) * (1 << 62))
    chosen = [list(r["vec"]) for r in whole.filter(share).orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()]
    ready = write_once(_with_distances(whole, chosen), "topk-pivot-table")
    queries = ready.filter(F.pmod("vec_id", F.lit(every)) == 0)
    return search_blocks(queries, ready, _kernel(k), k, "long", queries.count(), n)
