"""Mixing sources to target weights by hash-threshold histograms.

Words are summed by source and hash bucket; the bucket in which a source's budget runs out
is found from the running sums, and only the documents of that bucket are binned again, by
the next bits of the hash, until the boundary is a single hash value. The documents below
the boundary are the mix: a filter on the hash, with no sort of documents. A smaller budget
gives a smaller boundary, so mixes of rising budgets are nested.

Targets. Sources are numbered by code point (null last) and weigh ``weights`` in turn. They
share the whole by weight; a target stops at ``max_repeat`` times the source's own size, and
the excess is shared again by weight until none is above. A target above the source's size is
met by whole repeats of every document plus one more copy of those below the boundary.

Defined results. A null text has size 0. A null source is a source of its own. An empty
table gives an empty result. Sources without words get target 0. Rows with equal ids and texts share
a hash and are taken alike; rows without id, or with one id and other texts, are told apart by the text.
Very long texts are counted and hashed as a whole. Input columns with the names of the output columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from playstats.llm.common import WORD, small_join, write_once
from playstats.operators.ranking import global_row_number

WEIGHTS = (5, 2, 1)
BITS = 12          # bits of the hash per refinement: 4096 buckets a source
HASH_BITS = 63
OUT = ("size", "source_size", "target", "taken", "copies")


def _source_targets(slim: DataFrame, weights: tuple[int, ...], max_repeat: float) -> DataFrame:
    """One row a source: key, size and target (``max_repeat`` applied by water filling)."""
    sizes = slim.groupBy("_mx_key").agg(F.sum("_mx_size").alias("_mx_total"))
    ranked = global_row_number(sizes, [("_mx_key", True)], "_mx_rank", nulls_first=False)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.col("_mx_rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    src = write_once(ranked.select("_mx_key", "_mx_total", w.alias("_mx_w")), "mix-sources")
    cap = F.col("_mx_total") * F.lit(float(max_repeat))
    total, weight = src.agg(F.sum("_mx_total"), F.sum("_mx_w")).first()
    level = float(total or 0) / float(weight or 1)
    while True:  # the share per unit of weight only rises, so each source is capped once
        over = F.col("_mx_w") * level > cap
        taken, free = src.agg(F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("_mx_w")))).first()
        higher = (float(total or 0) - float(taken or 0)) / float(free) if free else level
        if higher <= level:
            break
        level = higher
    return src.withColumn("_mx_target", F.least(cap, F.col("_mx_w") * F.lit(level)))


def _boundaries(slim: DataFrame, plan: DataFrame, n_sources: int) -> DataFrame:
    """(key, cut): documents whose hash is below ``cut`` get one more copy."""
    state = plan.select("_mx_key", F.lit(0).cast("long").alias("_mx_lo"), "_mx_budget")
    done = None
    used = 0
    while True:
        step = min(BITS, HASH_BITS - used)
        shift = HASH_BITS - used - step
        # the rows whose hash begins with the source's prefix so far
        rows = small_join(slim.filter("_mx_size > 0"), state, "_mx_key", rows=n_sources)
        if used:
            rows = rows.filter(F.shiftright("_mx_h", HASH_BITS - used)
                               == F.shiftright("_mx_lo", HASH_BITS - used))
        hist = (rows.groupBy("_mx_key", F.shiftright("_mx_h", shift).alias("_mx_b"))
                .agg(F.sum("_mx_size").alias("_mx_n"), F.min("_mx_h").alias("_mx_min"),
                     F.max("_mx_h").alias("_mx_max"), F.first("_mx_budget").alias("_mx_budget")))
        run = F.sum("_mx_n").over(Window.partitionBy("_mx_key").orderBy("_mx_b"))
        edge = (hist.withColumn("_mx_run", run).filter("_mx_run > _mx_budget")
                .groupBy("_mx_key")
                .agg(F.min_by(F.struct("_mx_b", "_mx_min", "_mx_max", "_mx_n",
                                       (F.col("_mx_budget") - F.col("_mx_run") + F.col("_mx_n"))
                                       .alias("_mx_left")), "_mx_b").alias("_mx_e"))
                .select("_mx_key", "_mx_e.*"))
        used += step
        edge = write_once(edge.withColumn("_mx_one", F.lit(used == HASH_BITS)
                                          | (F.col("_mx_min") == F.col("_mx_max"))), "mix-edge")
        one = edge.filter("_mx_one").select(
            "_mx_key", F.when(F.col("_mx_left") * 2 >= F.col("_mx_n"), F.col("_mx_max") + 1)
            .otherwise(F.col("_mx_min")).alias("_mx_cut"))
        done = one if done is None else done.unionByName(one)
        state = edge.filter(~F.col("_mx_one")).select(
            "_mx_key", F.shiftleft("_mx_b", shift).alias("_mx_lo"),
            F.col("_mx_left").alias("_mx_budget"))
        n_sources = state.count()
        if not n_sources:
            return done


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
                max_repeat: int = 3) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``taken`` (words, with repeats)."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    h = F.xxhash64(id_col, text_col).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    slim = write_once(docs.select(F.col(id_col).alias("_mx_id"), key.alias("_mx_key"),
                                  size.alias("_mx_size"), h.alias("_mx_h")), "mix-sizes")
    targets = _source_targets(slim, weights, max_repeat)
    whole = F.when(F.col("_mx_total") > 0, F.floor(F.col("_mx_target") / F.col("_mx_total"))) \
        .otherwise(F.lit(0)).cast("long")
    plan = write_once(targets.withColumn("_mx_whole", whole).withColumn(
        "_mx_budget", F.col("_mx_target") - F.col("_mx_whole") * F.col("_mx_total")), "mix-plan")
    n_sources = plan.count()
    cuts = _boundaries(slim, plan.filter("_mx_total > 0"), n_sources)
    plan = plan.join(cuts, "_mx_key", "left")
    keep = [c for c in docs.columns if c not in OUT]
    body = docs.select(*keep, key.alias("_mx_key"), size.alias("_mx_size"), h.alias("_mx_h"))
    return _apply(body, plan, n_sources, keep)


def _apply(body: DataFrame, plan: DataFrame, n_sources: int, keep: list[str]) -> DataFrame:
    more = (F.col("_mx_h") < F.coalesce(F.col("_mx_cut"), F.lit(0))).cast("long")
    return (small_join(body, plan.select("_mx_key", "_mx_total", "_mx_target", "_mx_whole", "_mx_cut"),
                       "_mx_key", rows=n_sources)
            .select(*keep, F.col("_mx_size").alias("size"), F.col("_mx_total").alias("source_size"),
                    F.col("_mx_target").alias("target"),
                    (F.col("_mx_size") * (F.col("_mx_whole") + more)).alias("taken"),
                    (F.col("_mx_whole") + more).alias("copies")))


def take(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: each document as often as the mix takes it (not at all for 0)."""
    times = F.array_repeat(F.lit(1), F.col("copies").cast("int"))
    return mixed.withColumn("_mx_copy", F.explode(times)).select(*columns)
