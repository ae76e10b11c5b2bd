"""MinHash near-duplicates with sequential Bayesian verification.

1. Every document's shingle set, MinHash signature and band keys are made in one pass; equal
   sets become one class, named after its smallest ``doc_id``.
2. Classes that share a band key are candidates. A bucket never yields all its pairs: each
   member meets the bucket's hub, the member with the most band neighbours (in a group of
   near copies, the text they derive from).
3. Candidates are verified in turn: signatures are compared batch by batch, and a pair goes
   when the posterior probability that its similarity reaches the threshold falls below
   ``miss`` (uniform prior); survivors are confirmed on the full sets.
4. Links join classes to components. Buckets that still span several components are compared
   between components, in blocks: members outside the bucket's largest component meet all members
   of other components. A first pass confirms the best pair of each member and component, which
   joins what belongs together; a second one confirms all pairs that are left. So a pair that
   shares a bucket is either connected or has been compared; hubs and the first pass only save work.
5. In these passes a pair of large groups' members goes without a look at its sets if their
   differences from a common reference forbid the link. With D the set of shingles in which a member
   differs from the reference and u those of them that no other member of the group has, two members
   share at most min(|D| - u) differences, so they differ in at least the rest, which bounds their
   similarity from above. This is exact; independent edits of one text, which make almost all such
   pairs, cannot pass it.

Misses. A pair at the threshold shares no band with probability (1 - t^rows)^bands, 5e-8 at
0.8 and 5e-11 at 0.85 with 32 bands of 4; pruning adds at most ``miss`` (1e-6) a batch.

Defined results. A document without words has an empty set and is linked with nothing. Rows
that repeat a ``doc_id`` are each assigned by their own text; a class is named after the
smallest id that has its set. Null ids form classes but name none while another id has
the set. An empty table gives an empty result. Input columns named like the output columns are
replaced.

Scale. Signatures (512 bytes a document) are written once. Texts are read again only for the
classes that share a band key, once. Band keys move once, buckets of one class are dropped by a
map-side count, and the hot ones are pre-aggregated (hub) and split (join) by Spark.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import small_batches, write_once
from playstats.llm.components import connected_components
from playstats.llm.shingles import band_keys, multipliers, shingle_set, signature

HASHES, ROWS, BATCH = 128, 4, 32
MISS = 1e-6
STRAYS, BODY = 512, 4096     # members a block of the exhaustive comparison
ROWS_A_CALL = 2000           # rows of small buckets a call
OUT = ("n_shingles", "component_id", "kept")


def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest matches in ``n`` hashes with P(similarity >= threshold | matches) >= ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail at t is
    the chance of at most m successes in n + 1 trials of probability t.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def _batches(threshold: float, miss: float) -> list[tuple[int, int, int]]:
    return [(a, a + BATCH, least_matches(a + BATCH, threshold, miss)) for a in range(0, HASHES, BATCH)]


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, set_id, sig, bands) of every row; set_id, sig and bands are null without words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.binary()),
                        ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def sketch(batches):
        mult = multipliers(HASHES)
        for batch in small_batches(batches):
            n, ids, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width)
                n.append(len(s))
                ids.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                if len(s):
                    sigs.append(signature(s, mult))
            keys = iter(band_keys(np.stack(sigs), ROWS).tolist() if sigs else [])
            raw = iter([s.tobytes() for s in sigs])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array([next(raw) if k else None for k in n], pa.binary()),
                 pa.array([next(keys) if k else None for k in n], pa.list_(pa.int64()))], schema=schema)

    return docs.mapInArrow(sketch, "doc_id long, n long, set_id binary, sig binary, bands array<long>")


def _full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, set_id, shingles) with the set as little-endian 64-bit values."""
    schema = pa.schema([("doc_id", pa.int64()), ("set_id", pa.binary()), ("shingles", pa.binary())])

    def sets(batches):
        for batch in small_batches(batches):
            raw = [shingle_set(t, width).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([hashlib.md5(r).digest() for r in raw], pa.binary()),
                 pa.array(raw, pa.binary())], schema=schema)

    return docs.mapInArrow(sets, "doc_id long, set_id binary, shingles binary")


def _matrix(col) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), dtype=np.uint32).reshape(len(col), HASHES)


def _promising(pairs: DataFrame, nodes: DataFrame, threshold: float, miss: float) -> DataFrame:
    """The pairs (a, b) that survive the sequential comparison of their signatures."""
    steps = _batches(threshold, miss)

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _matrix(batch.column(2)), _matrix(batch.column(3))
            alive, hits = np.arange(len(x)), np.zeros(len(x), np.int64)
            for lo, hi, least in steps:
                hits[alive] += (x[alive, lo:hi] == y[alive, lo:hi]).sum(axis=1)
                alive = alive[hits[alive] >= least]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(alive)),
                                              batch.column(1).take(pa.array(alive))], ["a", "b"])

    sig = nodes.select("node", "sig")
    return (pairs.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(compare, "a long, b long"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""

    def compare(batches):
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = len(x) + len(y) - len(np.union1d(x, y))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], ["a", "b"])

    return (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long"))


def _node_sets(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of ``nodes`` (node, set_id), from the texts of their documents."""
    texts = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text")
    return (_full_sets(texts, width).dropDuplicates(["doc_id", "set_id"])
            .join(nodes.select(F.col("node").alias("doc_id"), "set_id"), ["doc_id", "set_id"])
            .select(F.col("doc_id").alias("node"), "shingles"))


def _differences(open_buckets: DataFrame, degree: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, size, diff, own): set size, |D| and u against the reference of the node's group.

    A group is what the open buckets connect; its reference is its node with the most neighbours.
    """
    least = open_buckets.groupBy("bk").agg(F.min("node").alias("b"))
    group = connected_components(open_buckets.join(least, "bk").select(F.col("node").alias("a"), "b"))
    known = write_once(group.join(degree, "node").select("node", F.col("component").alias("grp"), "deg"), "neardup-groups")
    ref = known.groupBy("grp").agg(F.max(F.struct("deg", "node")).alias("r")).select("grp", F.col("r.node").alias("ref"))
    against = (sets.join(known, "node").join(ref, "grp")
               .join(sets.select(F.col("node").alias("ref"), F.col("shingles").alias("base")), "ref")
               .select("grp", "node", "shingles", "base"))
    schema = pa.schema([("grp", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("x", pa.list_(pa.int64()))])

    def differ(batches):
        for batch in batches:
            sizes, diffs = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                sizes.append(len(x))
                diffs.append(np.setxor1d(x, y, assume_unique=True).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                                              pa.array(diffs, pa.list_(pa.int64()))], schema=schema)

    diffs = write_once(against.mapInArrow(differ, "grp long, node long, size long, x array<long>"), "neardup-differences")
    alone = (diffs.select("grp", "node", F.explode("x").alias("x")).groupBy("grp", "x")
             .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).filter("n = 1")
             .groupBy("node").agg(F.count(F.lit(1)).alias("own")))
    return diffs.select("node", "size", F.size("x").cast("long").alias("diff")).join(alone, "node", "left") \
        .select("node", "size", "diff", F.coalesce("own", F.lit(0)).cast("long").alias("own"))


def _cross_pairs(open_buckets: DataFrame, nodes: DataFrame, differ: DataFrame, threshold: float, percent: int,
                 miss: float, best_only: bool) -> DataFrame:
    """Promising pairs between the components of each bucket.

    ``open_buckets``: (bk, band, node, comp). The members outside the bucket's largest component
    (the strays) are cut into blocks and meet all members, also in blocks. A pair counts in the
    first band that it shares only, and once if both are strays. ``best_only`` keeps the best
    pair of each stray and component of a block.
    """
    sizes = open_buckets.groupBy("bk", "comp").agg(F.count(F.lit(1)).alias("k"))
    shape = sizes.groupBy("bk").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("all"))
    shape = shape.select("bk", F.col("top.comp").alias("body"),
                         F.ceil((F.col("all") - F.col("top.k")) / STRAYS).cast("int").alias("ns"),
                         F.ceil(F.col("all") / BODY).cast("int").alias("nb"), "all")
    detail = nodes.select("node", "sig").join(differ, "node")
    cols = ["bk", "all", "band", "node", "comp", (F.col("comp") != F.col("body")).alias("out"), "sig", "size", "diff", "own"]
    rows = open_buckets.join(shape, "bk").join(detail, "node")
    spread = F.xxhash64("node", "bk")
    body = rows.select(*cols, F.lit(False).alias("stray"), F.explode(F.sequence(F.lit(0), F.col("ns") - 1)).alias("s"),
                       F.pmod(spread, "nb").cast("int").alias("t"))
    strays = rows.filter("comp != body").select(
        *cols, F.lit(True).alias("stray"), F.pmod(spread, "ns").cast("int").alias("s"),
        F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("t"))
    steps = _batches(threshold, miss)

    def block(v: dict[str, np.ndarray]) -> np.ndarray:
        """Pairs (2 x n) of one block's strays and members."""
        sig, node, comp, size, diff = (v[c] for c in ("sig", "node", "comp", "size", "diff"))
        y, shared, found = np.nonzero(~v["stray"])[0], diff - v["own"], []
        for x in np.nonzero(v["stray"])[0]:
            apart = diff[y] + diff[x] - 2 * np.minimum(shared[y], shared[x])     # least possible difference
            may = (100 + percent) * apart <= (100 - percent) * (size[y] + size[x])
            alive, hits = y[may & (comp[y] != comp[x]) & (~v["out"][y] | (node[y] > node[x]))], 0
            if not len(alive):
                continue
            for lo, hi, least in steps:
                hits = hits + (sig[alive, lo:hi] == sig[x, lo:hi]).sum(axis=1)
                ok = hits >= least
                alive, hits = alive[ok], hits[ok]
            same = (sig[alive].reshape(len(alive), HASHES // ROWS, ROWS) == sig[x].reshape(-1, ROWS)).all(axis=2)
            first = same.argmax(axis=1) == v["band"][x]
            alive, hits = alive[first], hits[first]
            if best_only and len(alive):
                order = np.lexsort((-hits, comp[alive]))
                alive = alive[order[np.append(True, np.diff(comp[alive][order]) != 0)]]
            found.append(np.stack([np.maximum(node[alive], node[x]), np.minimum(node[alive], node[x])]))
        return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["bk", "s", "t"])
        v = {c: pdf[c].to_numpy() for c in ("bk", "s", "t", "band", "node", "comp", "out", "stray", "size", "diff", "own")}
        v["sig"] = np.frombuffer(b"".join(pdf["sig"]), dtype=np.uint32).reshape(len(pdf), HASHES)
        new = np.any([np.diff(v[c]) != 0 for c in ("bk", "s", "t")], axis=0)
        edges = [0, *(np.nonzero(new)[0] + 1).tolist(), len(pdf)]
        ab = np.concatenate([block({c: x[lo:hi] for c, x in v.items()}) for lo, hi in zip(edges, edges[1:])], axis=1)
        return pd.DataFrame({"a": ab[0], "b": ab[1]})

    # small buckets go to the function many at a time, the blocks of large ones one by one
    n = open_buckets.count()
    small = F.pmod(F.xxhash64("bk"), F.lit(max(1, n // ROWS_A_CALL)))
    key = F.when(F.col("all") <= STRAYS, small).otherwise(-1 - F.pmod(F.xxhash64("bk", "s", "t"), F.lit(1 << 62)))
    return (body.unionByName(strays).groupBy(key.alias("call")).applyInPandas(compare, "a long, b long").distinct())


def _open(buckets: DataFrame, comps: DataFrame, name: str) -> DataFrame:
    """(bk, node, comp) of the buckets that span several components."""
    labelled = buckets.select("bk", "band", "node").join(comps, "node", "left").select(
        "bk", "band", "node", F.coalesce("component", "node").alias("comp"))
    still = labelled.groupBy("bk").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 != c1")
    return write_once(labelled.join(still.select("bk"), "bk"), name)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80, miss: float = MISS) -> DataFrame:
    """``docs`` without the text, plus n_shingles, component_id and kept (the component's
    smallest id). Linked: 100 * intersection >= percent * union of the sets of ``width``-word shingles."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    threshold = percent / 100
    sketch = write_once(_sketches(slim, width), "neardup-sketches")
    member = sketch.select("doc_id", "n", "set_id")
    first = member.filter("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("node")) \
        .filter("node is not null")
    classes = write_once(first, "neardup-classes")
    # one row a class: the sketch of the row that names it
    nodes = write_once(
        sketch.filter("n > 0").join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", "set_id"])
        .dropDuplicates(["doc_id", "set_id"])
        .select(F.col("doc_id").alias("node"), "set_id", "sig", "bands"), "neardup-nodes")
    keys = nodes.select("node", F.posexplode("bands").alias("band", "bk")).distinct()
    full = keys.groupBy("bk").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    buckets = write_once(keys.join(full, "bk"), "neardup-buckets")
    degree = write_once(buckets.groupBy("node").agg(F.sum("k").alias("deg")), "neardup-degree")
    # the full sets of all candidates, from their texts, once
    sets = write_once(_node_sets(nodes.select("node", "set_id").join(degree.select("node"), "node"), slim, width), "neardup-sets")
    hubs = (buckets.select("bk", "node").join(degree, "node")
            .groupBy("bk").agg(F.max(F.struct("deg", "node")).alias("h")).select("bk", F.col("h.node").alias("hub")))
    to_hub = (buckets.join(hubs, "bk").filter("node != hub")
              .select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct())
    tried = write_once(_promising(to_hub, nodes, threshold, miss), "neardup-hub-pairs")
    links = write_once(_confirmed(tried, sets, percent), "neardup-links")
    comps = connected_components(links)
    opened = _open(buckets, comps, "neardup-open")
    if not opened.isEmpty():
        differ = write_once(_differences(opened, degree, sets), "neardup-differ")
        for best_only in (True, False):
            # pairs tried before have been confirmed or refused
            fresh = write_once(_cross_pairs(opened, nodes, differ, threshold, percent, miss, best_only)
                               .join(tried, ["a", "b"], "left_anti"), "neardup-cross-pairs")
            if not fresh.isEmpty():
                more = write_once(_confirmed(fresh, sets, percent), "neardup-more-links")
                tried, links = tried.unionByName(fresh), links.unionByName(more)
                comps = connected_components(links)
                opened = _open(buckets, comps, "neardup-open")
    named = classes.join(comps, "node", "left").select("set_id", F.coalesce("component", "node").alias("comp"))
    return (member.join(named, "set_id", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("comp", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
