"""Blocks of queries against blocks of candidates, for the two vector searches.

Each (query block, candidate block) pair is one group of a cogrouped pandas function, so a
task holds two blocks whatever the table sizes, and Spark deals, retries and shuffles the pairs.
A block returns at most k rows a query; the best k of a query's blocks are ranked by a
window that is limited before its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 4096


def finite_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of every usable row: not null, not empty, all components present and finite.

    Where rows repeat an id, the smallest of their vectors stands for it. Null ids take no part.
    """
    v = F.col("vec")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def search_blocks(queries: DataFrame, candidates: DataFrame, kernel: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                  k: int, score_type: str, n_queries: int, n_candidates: int) -> DataFrame:
    """The k best (query_id, rank, vec_id, score) of each query, ties to the smaller vec_id.

    Both tables have vec_id and dim; only vectors of equal length meet. ``kernel`` takes a block
    of each and returns (query_id, vec_id, score) rows that hold the block's best k a query.
    """
    qn = max(1, -(-n_queries // QUERY_BLOCK))
    cn = max(1, -(-n_candidates // CANDIDATE_BLOCK))
    at = F.xxhash64("vec_id")
    q = (queries.withColumn("_qb", F.pmod(at, F.lit(qn)).cast("int"))
         .withColumn("_cb", F.explode(F.sequence(F.lit(0), F.lit(cn - 1)))))
    c = (candidates.withColumn("_cb", F.pmod(at, F.lit(cn)).cast("int"))
         .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(qn - 1)))))
    empty = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"),
                          "score": pd.Series(dtype="int64" if score_type == "long" else "float64")})

    def both(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        return kernel(qs, cs) if len(qs) and len(cs) else empty

    key = ["dim", "_qb", "_cb"]
    found = q.groupBy(*key).cogroup(c.groupBy(*key)).applyInPandas(
        both, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
