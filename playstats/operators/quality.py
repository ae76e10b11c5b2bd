"""Data-quality checks re-aimed from the schema's declared constraints (DQ1-DQ3).

They report; they do not enforce. Each is one aggregate or one anti join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, key_cols) -> DataFrame:
    """DQ1: key values occurring more than once, with their count."""
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def check_orphans(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str | None = None) -> DataFrame:
    """DQ2: child rows whose non-NULL key has no parent (NULL keys pass, as in SQL FKs)."""
    pk = parent_key or child_key
    parents = parent.select(F.col(pk).alias("_pk")).distinct()
    return (child.filter(F.col(child_key).isNotNull())
            .join(parents, F.col(child_key) == F.col("_pk"), "left_anti"))


def null_counts(df: DataFrame, table_name: str, cols=None) -> DataFrame:
    """DQ3: NULLs per column in one pass: (table_name, column_name, null_count)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("null_count"))
                      for c in cols])
    return wide.select(F.lit(table_name).alias("table_name"), F.inline(pairs))


def union_all(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
