"""Sharding by a k-d tree over document metadata, to shards of near equal bytes.

The tree splits a node at the weighted median of its widest metadata dimension, weights
being bytes, until every leaf is one shard (its target is the total over the shard count).
A node of k shards is cut at floor(k/2)/k of its bytes, so any shard count works.

Dimensions: size, language and source. Each has a 31-bit ordinate: a label's is its rank among the
table's distinct labels (as UTF-8 bytes), a number's its place between the least and the
largest; the width of a dimension in a node is its spread of ordinates as a share of the whole
table's (of equal widths the first named counts). Ties on an ordinate are ordered by a 32-bit
hash of the id, so a source that holds a third of all rows can be cut in the middle. Medians are found without sorting: bytes are summed
in 4096 bins of the 63-bit key a node, the bin with the cut is binned again, until it holds
one key or a share of the bytes below ``tolerance``. What reaches the driver is one
boundary a node and round; the histogram has at most 4096 rows a node.

Defined results. Size is the UTF-8 bytes of the text (null: none) plus 1; the checksum of a
null text is that of no bytes (0). Null metadata (of numbers also NaN) is an ordinate of its own, before
all others; infinite numbers lie at the ends. Very long texts count by their bytes. Rows with equal
ids share a shard unless their metadata differ, and each row has its own slot. An empty
table gives an empty result. More shards than rows leave some shards empty. Input columns
named like the output columns are replaced. Copies are not kept together: the law is
``bytes``, and a group of copies may hold more bytes than a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from playstats.llm.common import bucketed_number, write_once
from playstats.operators.ranking import dense_index

BINS = 12
KEY_BITS = 63
ORDINATES = (1 << 31) - 1
OUT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _number_ordinates(docs: DataFrame, numeric: tuple[str, ...]) -> dict[str, Column]:
    """Ordinates of numbers: their place between the least and the largest finite one (null and NaN: 0)."""
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numeric}
    finite = {c: F.when(F.abs(v) < float("inf"), v) for c, v in value.items()}
    ends = docs.agg(*[f(v).alias(f"{n}_{c}") for c, v in finite.items() for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for i, c in enumerate(numeric):
        lo, hi = ends[f"lo_{c}"] or 0.0, ends[f"hi_{c}"] or 0.0
        # halved, so that the span of the largest doubles is finite
        share = (value[c] / 2 - lo / 2) / ((hi / 2 - lo / 2) or 1.0)
        inside = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))     # these two pass over nulls
        out[f"_kd_n{i}"] = F.when(value[c].isNull(), 0).otherwise(F.floor(inside * (ORDINATES - 1)) + 1).cast("long")
    return out


def metadata_points(docs: DataFrame, keep: list[str], id_col: str, text_col: str, numeric: tuple[str, ...],
                    labels: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    """One row a document (``keep``, ``size``, ``text_crc32``, ``_kd_tie``, ordinates), and the ordinates' names."""
    numbers = {"_kd_size": F.coalesce(F.octet_length(text_col) + F.lit(1), F.lit(0)).cast("long"),
               **(_number_ordinates(docs, numeric) if numeric else {})}
    slim = docs.select(
        *keep, (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.encode(text_col, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(id_col).bitwiseAND(F.lit((1 << 32) - 1)).alias("_kd_tie"),
        *[c.alias(n) for n, c in numbers.items()], *[F.col(c).alias(f"_kd_l{i}") for i, c in enumerate(labels)])
    for i, c in enumerate(labels):
        # written, so that Spark knows its size: it is broadcast only where it is small
        ranks = write_once(dense_index(docs.select(F.col(c).alias("_kd_label")).filter("_kd_label is not null"),
                                       ["_kd_label"], "_kd_rank"), "shard-labels")
        last = ranks.agg(F.max("_kd_rank")).first()[0] or 0
        shift = max(0, last.bit_length() - 31)     # beyond 2^31 labels neighbours share an ordinate
        slim = (slim.join(ranks, F.col(f"_kd_l{i}") == F.col("_kd_label"), "left")
                .withColumn(f"_kd_s{i}", F.coalesce(F.shiftright("_kd_rank", shift), F.lit(0)).cast("long"))
                .drop(f"_kd_l{i}", "_kd_label", "_kd_rank"))
    dims = [*numbers, *[f"_kd_s{i}" for i in range(len(labels))]]
    return write_once(slim, "shard-sizes"), dims


def _cuts(rows: DataFrame, nodes: dict[int, tuple[int, float]], tolerance: float) -> dict[int, int]:
    """The key at which each node is cut; ``nodes``: node -> (total bytes, bytes to the left).

    The keys below the cut go left. One boundary row a node comes to the driver each round.
    """
    state = {n: (0, float(left)) for n, (_, left) in nodes.items()}   # prefix so far, bytes left
    cut: dict[int, int] = {}
    used = 0
    while state:
        step = min(BINS, KEY_BITS - used)
        shift = KEY_BITS - used - step
        node = F.col("_kd_node")
        inside = F.lit(False)
        left = F.lit(None).cast("double")
        for n, (prefix, need) in state.items():
            here = node == n
            if used:
                here = here & (F.shiftright("_kd_key", KEY_BITS - used) == prefix)
            inside, left = inside | here, F.when(node == n, F.lit(need)).otherwise(left)
        hist = (rows.filter(inside)
                .groupBy("_kd_node", F.shiftright("_kd_key", shift).alias("_kd_bin"))
                .agg(F.sum("size").alias("w"), F.min("_kd_key").alias("lo"), F.max("_kd_key").alias("hi")))
        run = F.sum("w").over(Window.partitionBy("_kd_node").orderBy("_kd_bin"))
        edge = (hist.withColumn("run", run).filter(F.col("run") >= left)
                .groupBy("_kd_node").agg(F.min_by(F.struct("_kd_bin", "w", "lo", "hi", "run"), "_kd_bin").alias("e"))
                .select("_kd_node", "e.*").collect())
        used += step
        seen = set()
        for e in edge:
            n, need = e["_kd_node"], state[e["_kd_node"]][1]
            rest = need - (e["run"] - e["w"])
            seen.add(n)
            if used == KEY_BITS or e["lo"] == e["hi"] or e["w"] <= tolerance * nodes[n][0]:
                cut[n] = e["hi"] + 1 if rest * 2 >= e["w"] else e["lo"]
                del state[n]
            else:
                state[n] = (e["_kd_bin"], rest)
        for n in [n for n in state if n not in seen]:   # rounding: nothing is left to cut
            cut[n] = (1 << KEY_BITS) - 1
            del state[n]
    return cut


def kd_shards(slim: DataFrame, dims: list[str], shards: int, tolerance: float = 1e-5) -> DataFrame:
    """``slim`` (with ``size``, ``_kd_tie`` and the ordinates ``dims``) plus its ``shard``."""
    spans = slim.agg(*[F.min(d).alias(f"lo_{d}") for d in dims], *[F.max(d).alias(f"hi_{d}") for d in dims]).first()
    whole = {d: max(1, (spans[f"hi_{d}"] or 0) - (spans[f"lo_{d}"] or 0)) for d in dims}
    leaves = {0: (0, shards)}                      # node -> (first shard, shards)
    rows = slim.withColumn("_kd_node", F.lit(0))
    while any(k > 1 for _, k in leaves.values()):
        stats = {r["_kd_node"]: r for r in rows.groupBy("_kd_node").agg(
            F.sum("size").alias("w"), *[F.min(d).alias(f"lo_{d}") for d in dims],
            *[F.max(d).alias(f"hi_{d}") for d in dims]).collect()}
        split, widest = {}, {}
        for n, (_, k) in leaves.items():
            if k > 1 and n in stats:
                s = stats[n]
                widest[n] = max(dims, key=lambda d: (s[f"hi_{d}"] - s[f"lo_{d}"]) / whole[d])
                split[n] = (s["w"], s["w"] * (k // 2) / k)
        key = F.lit(None).cast("long")
        for n, d in widest.items():
            key = F.when(F.col("_kd_node") == n, F.shiftleft(F.col(d), 32).bitwiseOR(F.col("_kd_tie"))).otherwise(key)
        keyed = rows.withColumn("_kd_key", key)
        cut = _cuts(keyed, split, tolerance)
        nxt: dict[int, tuple[int, int]] = {}
        side = F.col("_kd_node") * 2
        for n, (first, k) in leaves.items():
            if k == 1:
                nxt[2 * n] = (first, 1)
                continue
            half = k // 2
            nxt[2 * n], nxt[2 * n + 1] = (first, half), (first + half, k - half)
            if n in cut:
                side = F.when((F.col("_kd_node") == n) & (F.col("_kd_key") >= cut[n]), F.lit(2 * n + 1)).otherwise(side)
        rows = keyed.withColumn("_kd_node", side).drop("_kd_key")
        leaves = nxt
    shard = F.lit(0)
    for n, (first, _) in leaves.items():
        shard = F.when(F.col("_kd_node") == n, F.lit(first)).otherwise(shard)
    return rows.withColumn("shard", shard.cast("int")).drop("_kd_node")


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    numeric: tuple[str, ...] = (), labels: tuple[str, ...] = ("lang", "source"),
                    keep: list[str] | None = None) -> DataFrame:
    """One row a document: the ``keep`` columns (default: the id), size, text_crc32, law, shard,
    slot (gapless from 0 in its shard) and grown_shard (null under this law)."""
    keep = [c for c in (keep or [id_col]) if c not in OUT]
    slim, dims = metadata_points(docs, keep, id_col, text_col, numeric, labels)
    placed = write_once(kd_shards(slim, dims, shards).drop("_kd_tie", *dims), "shard-places")
    sizes = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    return (bucketed_number(placed, "shard", sizes, [*keep, "text_crc32"], [*keep, "text_crc32"], "slot")
            .select(*keep, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write ``docs`` as one folder a shard. ``id_col`` must be unique in ``placed``."""
    (docs.join(placed.select(id_col, "shard", "slot"), id_col)
     .repartition("shard", F.col("slot") % 64)
     .write.mode("error").partitionBy("shard").parquet(path))
