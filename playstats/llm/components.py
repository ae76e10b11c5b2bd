"""Connected components of an edge table, with DataFrame operations only.

Alternating large-star and small-star steps: in each, every node's smallest neighbour comes
from an aggregate with a map-side step and is joined back to the edges, so a node with very
many edges is pre-aggregated, and its join key is split by adaptive execution. The edges
of each round are written to the shared folder. The loop ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import write_once


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                 .first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); the component is its smallest node.

    Self-loops, repeated and null edges are ignored. An empty edge table gives an empty result.
    """
    cur = write_once(edges.filter("a is not null and b is not null and a != b")
                     .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                     .distinct(), "cc-edges")
    state = _digest(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(low, F.col("a") == F.col("u"))
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct(F.col("a").alias("a"), F.col("m").alias("b"))))
                         .alias("e")).select("e.a", "e.b").filter("a != b").distinct())
        cur = write_once(small, "cc-edges")
        now = _digest(cur)
        if now == state:
            break
        state = now
    roots = cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
