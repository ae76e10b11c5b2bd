"""Ranks without single-task windows.

``rank() OVER (ORDER BY x)`` with no PARTITION BY moves every row to one task
(``Exchange SinglePartition``), and ``rank() OVER (PARTITION BY g ORDER BY x)``
puts a whole group in one task, so one hot group (say a third of all rows) is
sorted by a single task. These operators give the same numbers with the work
spread over range partitions:

1. pre-aggregate to one row per distinct (group, sort key): tied rows become one
   row, and the partial aggregate runs map-side;
2. range-partition those keys by (group, sort order), so a large group is split
   over many partitions, and number the keys inside each (partition, group) with a
   window;
3. add offsets: for each (partition, group) the count of the same group's keys in
   earlier partitions. The offsets table has at most (partitions + groups) rows;
   with no groups it is at most ``num_partitions`` rows and is broadcast;
4. join the numbers back to the rows on (group, key); AQE splits skewed join sides.

The range-partitioned keys are checkpointed once, so the numbering and the offsets
see the same partition of every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playstats.session import cut_lineage

_PID = "_rk_pid"


def _sort_col(name: str, ascending: bool, nulls_first: bool | None) -> Column:
    c = F.col(name)
    if ascending:
        return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()
    # PostgreSQL places NULLs first in descending order unless told otherwise.
    return c.desc_nulls_last() if nulls_first is False else c.desc_nulls_first()


def _number_distinct(keys: DataFrame, groups: list[str], order: list[Column], weight: str | None,
                     num_partitions: int | None) -> DataFrame:
    """Number rows of ``keys`` (unique on groups + order columns) within each group.

    Adds ``_pos`` (1-based position in the group) and, when ``weight`` is given,
    ``_before`` (sum of ``weight`` over the group's earlier rows).
    """
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    group_sort = [F.col(g).asc_nulls_first() for g in groups]
    ranged = keys.repartitionByRange(n, *group_sort, *order).withColumn(_PID, F.spark_partition_id())
    # The numbering and the offsets both read this frame; column pruning makes their
    # plans differ, so Spark would run the range exchange twice and could place a
    # key in different partitions. A reliable checkpoint (shared folder) fixes one
    # assignment for both and also survives a lost executor.
    ranged = cut_lineage(ranged)
    w = Window.partitionBy(_PID, *groups).orderBy(*order)
    local = ranged.withColumn("_lpos", F.row_number().over(w))
    if weight:
        local = local.withColumn(
            "_lcum", F.sum(weight).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    aggs = [F.count(F.lit(1)).alias("_pn")]
    if weight:
        aggs.append(F.sum(weight).alias("_pw"))
    per_part = local.groupBy(_PID, *groups).agg(*aggs)
    wp = Window.partitionBy(*groups).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1) \
        if groups else Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(
        F.col(_PID).alias("_o_pid"), *[F.col(g).alias(f"_o_{g}") for g in groups],
        F.coalesce(F.sum("_pn").over(wp), F.lit(0)).alias("_opos"),
        *([F.coalesce(F.sum("_pw").over(wp), F.lit(0)).alias("_ow")] if weight else []),
    )
    cond = F.col(_PID) == F.col("_o_pid")
    for g in groups:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    # without groups: one row per range partition, bounded by n, so broadcast
    right = offsets if groups else F.broadcast(offsets)
    out = local.join(right, cond).drop("_o_pid", *[f"_o_{g}" for g in groups])
    out = out.withColumn("_pos", (F.col("_opos") + F.col("_lpos")).cast("long"))
    drop = [_PID, "_lpos", "_opos"]
    if weight:
        out = out.withColumn(
            "_before", (F.col("_ow") + F.coalesce(F.col("_lcum"), F.lit(0))).cast("long"))
        drop += ["_lcum", "_ow"]
    return out.drop(*drop)


def grouped_rank(df: DataFrame, groups: list[str], order: list[tuple[str, bool]], out: str = "rank",
                 method: str = "rank", nulls_first: bool | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = rank / dense_rank / percent_rank within ``groups`` ordered by ``order``.

    ``order`` is a list of (column, ascending). Ties share a number, as in SQL.
    ``groups=[]`` ranks the whole frame.
    """
    return grouped_ranks(df, groups, order, {out: method}, nulls_first, num_partitions)


def grouped_ranks(df: DataFrame, groups: list[str], order: list[tuple[str, bool]], outs: dict[str, str],
                  nulls_first: bool | None = None, num_partitions: int | None = None) -> DataFrame:
    """Several rank columns (name -> method) from one numbering of the distinct keys.

    ``df`` is read twice (its keys, and the rows the ranks are joined to); a caller whose
    ``df`` is costly stores it first.
    """
    if not set(outs.values()) <= {"rank", "dense_rank", "percent_rank"}:
        raise ValueError(outs)
    names = [c for c, _ in order]
    sort = [_sort_col(c, asc, nulls_first) for c, asc in order]
    keys = df.groupBy(*groups, *names).agg(F.count(F.lit(1)).alias("_kn"))
    numbered = _number_distinct(keys, list(groups), sort, "_kn", num_partitions)
    values = {"dense_rank": F.col("_pos").cast("long"), "rank": (F.col("_before") + 1).cast("long")}
    if "percent_rank" in outs.values():
        sizes = keys.groupBy(*groups).agg(F.sum("_kn").alias("_gn"))
        if groups:
            sizes = sizes.select(*[F.col(g).alias(f"_s_{g}") for g in groups], "_gn")
            scond = None
            for g in groups:
                e = F.col(g).eqNullSafe(F.col(f"_s_{g}"))   # NULL is a group too
                scond = e if scond is None else scond & e
            numbered = numbered.join(sizes, scond, "left").drop(*[f"_s_{g}" for g in groups])
        else:
            numbered = numbered.crossJoin(F.broadcast(sizes))  # one row
        values["percent_rank"] = F.when(F.col("_gn") > 1, F.col("_before").cast("double") / (F.col("_gn") - 1)) \
            .otherwise(F.lit(0.0))
    key_cols = [*groups, *names]
    numbered = numbered.select(*[F.col(c).alias(f"_k_{c}") for c in key_cols],
                               *[values[method].alias(out) for out, method in outs.items()])
    cond = None
    for c in key_cols:
        e = df[c].eqNullSafe(numbered[f"_k_{c}"])
        cond = e if cond is None else cond & e
    return df.join(numbered, cond, "inner").drop(*[f"_k_{c}" for c in key_cols])


def global_rank(df: DataFrame, order: list[tuple[str, bool]], out: str = "rank",
                method: str = "rank", nulls_first: bool | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = rank / dense_rank over the whole frame ordered by ``order``."""
    return grouped_rank(df, [], order, out, method, nulls_first, num_partitions)


def grouped_row_number(df: DataFrame, groups: list[str], order: list[tuple[str, bool]],
                       out: str = "row_no", nulls_first: bool | None = None,
                       num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = row_number within ``groups``; groups + order must be unique per row."""
    sort = [_sort_col(c, asc, nulls_first) for c, asc in order]
    numbered = _number_distinct(df, list(groups), sort, None, num_partitions)
    return numbered.withColumnRenamed("_pos", out)


def global_row_number(df: DataFrame, order: list[tuple[str, bool]], out: str = "row_no",
                      nulls_first: bool | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = row_number over the whole frame; ``order`` must be a total order."""
    return grouped_row_number(df, [], order, out, nulls_first, num_partitions)


def dense_index(df: DataFrame, key_cols: list[str], out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Surrogate keys 1..n for the distinct values of ``key_cols``, ordered by them.

    Ids depend only on the values, not on file order, so reruns give the same ids.
    """
    distinct = df.select(*key_cols).distinct()
    return global_row_number(distinct, [(c, True) for c in key_cols], out,
                             nulls_first=False, num_partitions=num_partitions)
