"""Distance and similarity of every row against one target row.

The target is a single row (one track), joined by broadcast nested loop: a fixed,
one-row build side. Scores are generated column expressions over the feature
columns, so the whole scan stays in one whole-stage-codegen span; top-n is a
``TakeOrderedAndProject`` (per-partition heaps, then a final merge of n rows each).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def dot(cols, prefix_a: str = "", prefix_b: str = "t_") -> Column:
    return _sum([F.col(f"{prefix_a}{c}").cast("double") * F.col(f"{prefix_b}{c}").cast("double")
                 for c in cols])


def norm(cols, prefix: str = "") -> Column:
    return F.sqrt(_sum([F.col(f"{prefix}{c}").cast("double") * F.col(f"{prefix}{c}").cast("double")
                        for c in cols]))


def sq_dist(cols, prefix_a: str = "", prefix_b: str = "t_") -> Column:
    return _sum([(F.col(f"{prefix_a}{c}").cast("double") - F.col(f"{prefix_b}{c}").cast("double"))
                 * (F.col(f"{prefix_a}{c}").cast("double") - F.col(f"{prefix_b}{c}").cast("double"))
                 for c in cols])


def with_target(df: DataFrame, target: DataFrame, cols, id_col: str) -> DataFrame:
    """Attach the target's id and feature columns (prefixed ``t_``) to every row.

    ``target`` must hold exactly one row (callers build it with ``limit(1)``).
    """
    t = target.select(F.col(id_col).alias(f"t_{id_col}"),
                      *[F.col(c).alias(f"t_{c}") for c in cols])
    return df.crossJoin(F.broadcast(t.limit(1)))


def cosine_to_target(df: DataFrame, target: DataFrame, cols, id_col: str = "track_id",
                     out: str = "cosine_similarity") -> DataFrame:
    """Rows other than the target with their cosine similarity to it (NULL norms dropped).

    A zero norm gives NULL (``nullif``), which is then filtered out, as in the SQL.
    """
    j = with_target(df, target, cols, id_col).filter(F.col(id_col) != F.col(f"t_{id_col}"))
    den = norm(cols) * norm(cols, "t_")
    cos = dot(cols) / F.when(den != 0, den)
    return j.withColumn(out, cos).filter(F.col(out).isNotNull())


def euclidean_to_target(df: DataFrame, target: DataFrame, cols, id_col: str = "track_id",
                        out: str = "distance") -> DataFrame:
    """Rows other than the target (excluded by id, D9) with their Euclidean distance."""
    j = with_target(df, target, cols, id_col).filter(F.col(id_col) != F.col(f"t_{id_col}"))
    return j.withColumn(out, F.sqrt(sq_dist(cols)))


def drop_target_cols(df: DataFrame, cols, id_col: str) -> DataFrame:
    return df.drop(f"t_{id_col}", *[f"t_{c}" for c in cols])
