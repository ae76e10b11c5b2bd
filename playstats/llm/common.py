"""Helpers shared by the training-data operators.

White space is the six ASCII characters ``[\\x20\\x09-\\x0D]`` and case folding is A-Z
only, in every operator, so the JVM, Python and SQL sides agree byte for byte.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from playstats.session import ensure_checkpoint_dir

WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = "[^\\x20\\x09-\\x0D]+"

# A table with at most this many rows may be broadcast; every use counts the rows first
# and joins by shuffle beyond it.
BROADCAST_ROWS = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_once(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage, lets later reads prune columns, and survives lost executors.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(columns: list[str]) -> Column:
    """128 bits that tell rows apart by all of ``columns``: nulls differ from empty texts, and values from their neighbours'."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.md5(F.col(f"`{c}`").cast("string")), F.lit("-")) for c in columns]))


def small_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
               rows: int | None = None) -> DataFrame:
    """Join a large ``left`` with a table whose row count has been measured (``rows``).

    Broadcast up to BROADCAST_ROWS rows; beyond it a shuffle join, whose hot keys
    adaptive execution splits.
    """
    n = right.count() if rows is None else rows
    return left.join(F.broadcast(right) if n <= BROADCAST_ROWS else right, on, how)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, UPPER.lower())


NUMBER_ROWS = 1_000        # rows a bucket of bucketed_number, up to NUMBER_BUCKETS a group
NUMBER_BUCKETS = 100_000


def bucketed_number(df: DataFrame, group: str, sizes: dict[int, int], spread: list[str], order: list[str],
                    out: str) -> DataFrame:
    """Number the rows of each ``group`` gaplessly from 0 without sorting a large group in one task.

    ``sizes`` has the row count of every group (few groups). The rows of a group are dealt to
    hash buckets of ``spread``; each (group, bucket) is numbered by itself and moved up by the
    rows of the group's earlier buckets. Rows equal in ``spread`` and ``order`` are interchangeable.
    """
    share = {g: min(NUMBER_BUCKETS, -(-n // NUMBER_ROWS)) for g, n in sizes.items() if n > NUMBER_ROWS}
    buckets = F.lit(1)
    if share:
        table = F.create_map(*[F.lit(x) for gn in share.items() for x in gn])
        buckets = F.coalesce(table[F.col(group)], buckets)
    b = df.withColumn("_bn_b", F.pmod(F.xxhash64(*spread), buckets).cast("int"))
    counts = b.groupBy(group, "_bn_b").agg(F.count(F.lit(1)).alias("_bn_n"))
    before = Window.partitionBy(group).orderBy("_bn_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_bn_g"), F.col("_bn_b").alias("_bn_s"),
                           F.coalesce(F.sum("_bn_n").over(before), F.lit(0)).alias("_bn_0"))
    inside = Window.partitionBy(group, "_bn_b").orderBy(*order)
    numbered = b.withColumn("_bn_i", F.row_number().over(inside))
    return (numbered.join(starts, (F.col(group) == F.col("_bn_g")) & (F.col("_bn_b") == F.col("_bn_s")))
            .withColumn(out, (F.col("_bn_0") + F.col("_bn_i") - 1).cast("long"))
            .drop("_bn_b", "_bn_i", "_bn_g", "_bn_s", "_bn_0"))


def small_batches(batches, text: int = 1, size: int = 4_000_000):
    """Arrow batches cut to about ``size`` bytes of the text column (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = max(1, int(n * size / max(size, batch.column(text).nbytes)))
        for at in range(0, n, rows):
            yield batch.slice(at, rows)
