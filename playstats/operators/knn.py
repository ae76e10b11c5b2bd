"""Exact k nearest neighbours of every row (S5), and the neighbour graph built on them (M2, M3).

Rows are dealt to the cells of about sqrt(n) pivots (nearest pivot); each cell keeps the smallest and largest
distance of its rows to its pivot. Neighbouring cells make up ``SPREAD`` blocks of about equal size, more
where a block would pass ``BLOCK`` rows or ``BLOCK_BYTES`` bytes, and a cell beyond that is cut by hash.

* *Round 1.* Each row finds its k best in its own block, and so an upper bound of its k-th distance.
* *Round 2.* A row visits only the other blocks with cells that can beat this bound, and there only these cells. Two blocks
  meet once, for both directions. A row q and a cell with pivot p whose rows are lo to hi away from p are at least ``d(q, p) - hi`` and ``lo - d(q, p)`` apart, and as a
  cell's rows are nearer to p than to q's own pivot o, at least ``(d(q, p)^2 - d(q, o)^2) / 2 d(p, o)``. Bounds are
  widened by more than rounding can take from them, so the result is exact.

A row travels at most once for each other block, however many cells it must see: what is shuffled is ``SPREAD`` times the
vectors while ``SPREAD`` blocks hold them, in the components' own type, and each task has two blocks of bounded size. Where no
cell can be left out, as among vectors of many dimensions, the pairs themselves are quadratic; they are
multiplied in portions of ``PORTION`` rows. Equal vectors
are one class while searching: a vector that a third of all rows share is searched once, and the
class's members, at most k + 1 for each, are put back at the end.

Distances are compared at 9 decimal places, then by id, so last-bit differences cannot change a
result. Defined results: rows without id or vector, with null or non-finite components, and for the
cosine metric zero vectors, take no part; rows that repeat an id count once (smallest vector). With
fewer than k other rows all are returned. Vectors of different lengths are an error.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstats.session import cut_lineage

BLOCK = 98_304              # rows a block at most
BLOCK_BYTES = 64 << 20      # bytes of its vectors
SPREAD = 8                  # blocks, about, of a table that needs no more, of SPREAD_ROWS rows at least
SPREAD_ROWS = 512
PORTION = 2048              # rows multiplied at a time
MAX_PIVOTS = 16_384         # bounds the pivot table sent to tasks; larger cells are cut into blocks
PLACES = 9
TIE = 2e-9                  # two distances this close may round alike


@dataclass(frozen=True)
class Neighbours:
    """``rows``: (id, rank, neighbour_id, distance). ``visited``: share of all (row, cell) pairs searched; ``sent``: blocks that a row asks, on average."""

    rows: DataFrame
    visited: float
    cells: int
    sent: float = 0.0


def usable_vectors(points: DataFrame, id_col: str, vector_col: str, metric: str, kind: str = "double") -> DataFrame:
    """(id, vec) of the rows that take part; vec is an array of ``kind``."""
    v = F.col("vec")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (points.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("vec"))
            .filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
            .groupBy("id").agg(F.min("vec").alias("vec")))
    return rows.filter(F.exists("vec", lambda x: x != 0)) if metric == "cosine" else rows


def _distances(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``q`` to all of ``c``, up to rounding (see ``_slack``)."""
    square = (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (q @ c.T)
    return np.sqrt(np.maximum(square, 0))


def _slack(q: np.ndarray, largest: float) -> np.ndarray:
    """More than the rounding of :func:`_distances`, a row."""
    return 1e-6 * (np.sqrt((q * q).sum(axis=1)) + largest) + 1e-12


def _apart(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """The distances that are returned, of each row of ``x`` to the same row of ``y``."""
    return 1 - np.einsum("ij,ij->i", x, y) if metric == "cosine" else np.sqrt(((x - y) ** 2).sum(axis=1))


def _best(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int, metric: str):
    """(row of q, id, distance) of the k best of the block ``c`` for each row of ``q``, itself left out."""
    if metric == "cosine":
        d = 1 - q @ c.T
        reach = TIE
    else:
        d = (q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * (q @ c.T)
        reach = (1e-12 * ((q * q).sum(axis=1) + (c * c).sum(axis=1).max(initial=0)))[:, None]
    d[qid[:, None] == cid[None, :]] = np.inf
    if c.shape[0] > k:
        kth = np.partition(d, k - 1, axis=1)[:, k - 1:k]
        if metric != "cosine":      # squares: a distance may grow by TIE and still round alike
            kth = (np.sqrt(np.maximum(kth, 0)) + TIE) ** 2
        keep = (d <= kth + reach) & np.isfinite(d)
    else:
        keep = np.isfinite(d)
    i, j = np.nonzero(keep)
    far = _apart(q[i], c[j], metric)
    order = np.lexsort((cid[j], np.round(far, PLACES), i))
    i, j, far = i[order], j[order], far[order]
    place = np.arange(len(i)) - np.searchsorted(i, i, side="left")
    top = place < k
    return i[top], cid[j[top]], far[top]


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """About sqrt(n) vectors drawn by hash of the id."""
    want = min(MAX_PIVOTS, max(1, math.ceil(math.sqrt(n))))
    share = F.xxhash64("rep", F.lit(7)).bitwiseAND(F.lit((1 << 62) - 1)) < int(min(1.0, 20 * want / max(1, n)) * (1 << 62))
    drawn = vectors.filter(share).orderBy(F.xxhash64("rep", F.lit(7)), "rep").limit(want).select("vec", "length").collect()
    drawn = drawn or vectors.orderBy("rep").limit(1).select("vec", "length").collect()
    return np.asarray([r["vec"] for r in drawn], dtype=float) / np.asarray([[r["length"]] for r in drawn])


def _vectors(table: pa.Table, dims: int) -> np.ndarray:
    """``vec`` over ``length``, in double precision."""
    x = np.concatenate([c.flatten().to_numpy() for c in table["vec"].chunks] or [np.empty(0)]).astype(float).reshape(-1, dims)
    return x / table["length"].to_numpy()[:, None]


def _group_cells(centres: np.ndarray, rows: np.ndarray, limit: int) -> list[np.ndarray]:
    """Groups of neighbouring cells with at most ``limit`` rows each, larger cells by themselves: halved along the widest axis."""
    todo, out = [np.arange(len(rows))], []
    while todo:
        at = todo.pop()
        if len(at) == 1 or rows[at].sum() <= limit:
            out.append(at)
            continue
        at = at[np.argsort(centres[at, np.ptp(centres[at], axis=0).argmax()], kind="stable")]
        total = rows[at].cumsum()
        parts = -(-total[-1] // limit)      # the halves get whole shares of the limit
        cut = int(np.clip(np.searchsorted(total, total[-1] * (parts // 2) / parts, side="right"), 1, len(at) - 1))
        todo += [at[:cut], at[cut:]]
    return out


def _products_over(x: np.ndarray, y: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Flat places where the products of the rows of x with those of y reach ``least`` (one a row of x), none left out.

    Single precision, widened by twice its rounding, finds few places too many; where it cannot tell (many places, or
    sizes out of its range) double precision does.
    """
    size, other = np.sqrt((x * x).sum(axis=1)), np.sqrt((y * y).sum(axis=1).max())
    if max(size.max(), other) < 1e15:
        edge = (least - (x.shape[1] + 8) * 2.0 ** -23 * size * other - 1e-36).astype(np.float32)
        found = np.flatnonzero(x.astype(np.float32) @ y.astype(np.float32).T >= np.nextafter(edge, np.float32(-np.inf))[:, None])
        if len(found) <= len(x) * len(y) / 20 + 1000:
            return found
    return np.flatnonzero(x @ y.T >= least[:, None])


def _best_within(qid: np.ndarray, q: np.ndarray, reach: np.ndarray, low: np.ndarray, cid: np.ndarray, c: np.ndarray,
                 starts: np.ndarray, k: int, metric: str, longest: float):
    """(row of q, id, distance) of the k best rows of ``c`` for each row of ``q``, of those not beyond its ``reach``.

    ``c`` lies by cells that begin at ``starts``; ``low`` has the least distance of each row of q to each of them, and a
    cell is passed over by the rows that it cannot serve. ``reach`` is lowered to the k-th distance found.
    """
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    slack, square = _slack(q, longest), (q * q).sum(axis=1)
    half = (c * c).sum(axis=1) / 2
    side, other_side = (q, c) if metric == "cosine" else (np.c_[q, np.ones(len(q))], np.c_[c, -half])

    def settle(parts):
        i, near, far = (np.concatenate([h[x] for h in parts]) for x in range(3))
        order = np.lexsort((near, np.round(far, PLACES), i))
        i, near, far = i[order], near[order], far[order]
        top = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
        i, near, far = i[top], near[top], far[top]
        last = np.searchsorted(i, np.arange(len(q)), side="right") - 1
        full = np.bincount(i, minlength=len(q)) >= k
        reach[full] = np.minimum(reach[full], far[last[full]] + TIE)
        return [i, near, far]

    fresh, waiting = [], 0
    for cell in np.argsort(low.mean(axis=0), kind="stable").tolist():
        for at in range(int(starts[cell]), int(starts[cell + 1]), PORTION):
            end = min(at + PORTION, int(starts[cell + 1]))
            edge = np.sqrt(2 * np.maximum(reach, 0)) if metric == "cosine" else reach       # unit vectors: distance^2 = 2 - 2 cos
            rows = np.flatnonzero(low[:, cell] <= edge + slack)
            wide = np.isinf(reach[rows])
            if wide.any():
                i, near, far = _best(qid[rows[wide]], q[rows[wide]], cid[at:end], c[at:end], k, metric)
                fresh.append((rows[wide][i], near, far))
                waiting, rows = waiting + len(i), rows[~wide]
            if len(rows):
                x, y = q[rows], c[at:end]
                if metric == "cosine":
                    least = 1 - reach[rows] - TIE
                else:                 # distance^2 <= limit: x.y - |y|^2 / 2 >= (|x|^2 - limit) / 2
                    limit = (reach[rows] + TIE) ** 2 + 1e-12 * (square[rows] + 2 * half[at:end].max())
                    least = (square[rows] - limit) / 2
                i, j = np.divmod(_products_over(side[rows], other_side[at:end], least), len(y))
                far = _apart(x[i], y[j], metric)
                other = qid[rows[i]] != cid[at + j]
                fresh.append((rows[i[other]], cid[at + j[other]], far[other]))
                waiting += int(other.sum())
            if wide.any() or waiting > 4 * k * len(q):
                held, fresh, waiting = settle([held, *fresh]), [], 0
    return settle([held, *fresh])


def _search(vectors: DataFrame, n: int, k: int, metric: str) -> tuple[DataFrame, tuple[float, int, float]]:
    """(rep, near, distance) of the k nearest classes of each of (rep, vec, length); share of pairs visited, cells, blocks a row asks.

    What is compared is vec / length.
    """
    kind = vectors.schema["vec"].dataType.elementType.simpleString()
    pivots = _pivots(vectors, n)
    dims = pivots.shape[1]
    longest = float(np.sqrt((pivots ** 2).sum(axis=1)).max())

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                x = _vectors(pa.Table.from_batches([batch]), dims)
                d = np.concatenate([_distances(x[i:i + PORTION], pivots) for i in range(0, len(x), PORTION)])
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch["rep"], batch["vec"], batch["length"], pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(d)), cell])],
                                                 names=["rep", "vec", "length", "cell", "away"])

    held = f"rep long, vec array<{kind}>, length double, cell int"
    dealt = cut_lineage(vectors.select("rep", "vec", "length").mapInArrow(deal, f"{held}, away double"))
    sizes = {r["cell"]: (r["n"], r["lo"], r["hi"]) for r in dealt.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("away").alias("lo"), F.max("away").alias("hi")).collect()}    # a row a pivot
    used = np.asarray(sorted(sizes))
    count, lo, hi = (np.asarray([sizes[c][i] for c in used.tolist()]) for i in range(3))
    centres = pivots[used]
    limit = max(1, min(BLOCK, BLOCK_BYTES // (8 * dims), max(SPREAD_ROWS, -(-5 * n // (4 * SPREAD)))))      # room for uneven cells
    blocks, deals = [], []      # the cells of each block; (cell, its first block, its blocks)
    for group in _group_cells(centres, count, limit):
        parts = -(-int(count[group].sum()) // limit)      # more than one: a single large cell
        deals += [(int(used[i]), len(blocks), parts) for i in group.tolist()]
        blocks += [np.sort(group)] * parts

    def bounds(x: np.ndarray, own: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Least distances of the rows ``x``, dealt to the cells ``own``, to the rows of ``cells`` (both as places in ``used``)."""
        d = _distances(x, centres[cells])
        mine, at = np.unique(own, return_inverse=True)
        apart = np.maximum(_distances(centres[mine], centres[cells]), 1e-300)[at]
        home = ((x - centres[own]) ** 2).sum(axis=1)[:, None]
        plane = (d * d - home - 1e-9 * (d * d + longest ** 2)) / (2 * apart)
        plane[own[:, None] == cells[None, :]] = 0
        return np.maximum(np.maximum(d - hi[cells], lo[cells] - d), plane)

    def by_cell(table: pa.Table):
        """Ids, vectors, cells and cell starts of a block's rows, by cell; the table's order of them."""
        cell = np.searchsorted(used, table["cell"].to_numpy())
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        here, starts = np.unique(cell, return_index=True)
        return table["rep"].to_numpy()[order], _vectors(table, dims)[order], cell, here, np.append(starts, len(cell)), order

    def lists(i, near, far, rows: int) -> list[pa.Array]:
        """The ids and distances found for each of ``rows`` rows, a list a row; ``i`` is sorted."""
        ends = pa.array(np.searchsorted(i, np.arange(rows + 1)).astype(np.int32))
        return [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (near, far)]

    def choose(block: int, table: pa.Table) -> pa.Table:
        ids, x, cell, here, starts, order = by_cell(table)
        reach, seen, asks, found = np.full(len(x), np.inf), np.zeros(len(x), np.int32), [], []
        for own in range(len(here)):
            for at in range(int(starts[own]), int(starts[own + 1]), PORTION):
                rows = slice(at, min(at + PORTION, int(starts[own + 1])))
                low = bounds(x[rows], cell[rows], here)
                low[:, own] = -np.inf       # the own cell first
                i, near, far = _best_within(ids[rows], x[rows], reach[rows], low, ids, x, starts, k, metric, longest)
                found.append((i + at, near, far))
                edge = np.sqrt(2 * np.maximum(reach[rows], 0)) if metric == "cosine" else reach[rows]
                need = bounds(x[rows], cell[rows], np.arange(len(used))) <= (edge + _slack(x[rows], longest))[:, None]
                seen[rows] = need.sum(axis=1)
                visit = np.stack([need[:, b].any(axis=1) for b in blocks], axis=1)
                visit[:, block] = False
                asks += [np.flatnonzero(v).astype(np.int32) for v in visit]
        near, far = lists(*(np.concatenate(f) for f in zip(*found)), len(x))
        sorted_ = table.select(["rep", "vec", "length", "cell"]).take(pa.array(order))
        return pa.table({**{c: sorted_[c] for c in sorted_.column_names}, "reach": reach, "seen": seen,
                         "targets": pa.array(asks, pa.list_(pa.int32())), "block": pa.array(np.full(len(x), block, np.int32)),
                         "near": near, "distance": far})

    spark = vectors.sparkSession
    shares = F.broadcast(spark.createDataFrame(deals, "cell int, first int, parts int"))
    cut = dealt.join(shares, "cell").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("rep"), "parts")).cast("int"))
    rows = cut.select("block", "rep", "vec", "length", "cell")
    best = "near array<long>, distance array<double>"
    visits = cut_lineage(rows.repartition(len(blocks), "block").groupBy("block").applyInArrow(
        lambda key, table: choose(key[0].as_py(), table), f"{held}, reach double, seen int, targets array<int>, block int, {best}"))
    seen = visits.agg(F.sum("seen")).first()[0]
    pairs = visits.select("block", F.explode("targets").alias("target")).groupBy("block", "target").count().collect()   # blocks squared at most
    sent = 1 + sum(r["count"] for r in pairs) / n
    asking = {}      # the blocks that ask a block: all of its rows meet theirs
    for r in pairs:
        asking.setdefault(r["target"], []).append(r["block"])
    asked = F.broadcast(spark.createDataFrame(list(asking.items()), "block int, by array<int>"))
    asks = F.array_contains("targets", F.col("other"))
    meeting = (visits.join(asked, "block", "left")
               .withColumn("other", F.explode(F.array_union("targets", F.coalesce("by", F.array().cast("array<int>")))))
               .select(F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block",
                       "rep", "vec", "length", "cell", F.when(asks, F.col("reach")).alias("reach")))

    def meet(table: pa.Table) -> pa.Table:
        out, block, asks = [], table["block"].to_numpy(), table["reach"].is_valid().to_numpy()
        for mine in np.unique(block):
            qs, cs = table.filter(pa.array((block == mine) & asks)), table.filter(pa.array(block != mine))
            if qs.num_rows and cs.num_rows:
                ids, x, cell, _, _, order = by_cell(qs)
                reach = qs["reach"].to_numpy()[order]
                cid, c, _, here, starts, _ = by_cell(cs)
                for at in range(0, len(x), PORTION):
                    part = slice(at, at + PORTION)
                    low = bounds(x[part], cell[part], here)
                    got = _best_within(ids[part], x[part], reach[part], low, cid, c, starts, k, metric, longest)
                    out.append(pa.table([pa.array(ids[part]), *lists(*got, len(ids[part]))], names=["rep", "near", "distance"]))
        empty = pa.schema([("rep", pa.int64()), ("near", pa.list_(pa.int64())), ("distance", pa.list_(pa.float64()))]).empty_table()
        return pa.concat_tables(out) if out else empty

    tasks = max(1, 4 * len({frozenset(r[:2]) for r in pairs}))      # so that few pairs of blocks share one
    found = (meeting.repartition(tasks, "a", "b").groupBy("a", "b").applyInArrow(meet, f"rep long, {best}")
             .filter(F.size("near") > 0).unionByName(visits.select("rep", "near", "distance")))
    # lists travel, their entries do not
    each = found.repartition("rep").select("rep", F.inline(F.arrays_zip("near", "distance")))
    return _top(each, "rep", "near", k), (seen / (n * len(used)), len(used), sent)


def _top(found: DataFrame, by: str, near: str, k: int, out: str = "rank") -> DataFrame:
    best = Window.partitionBy(by).orderBy(F.round("distance", PLACES), near)
    return found.withColumn(out, F.row_number().over(best)).filter(F.col(out) <= k)


def nearest_neighbours(points: DataFrame, k: int, id_col: str = "id", vector_col: str = "vector",
                       metric: str = "cosine") -> Neighbours:
    """The k nearest other rows of every row: by cosine distance (1 - cos) or Euclidean distance (``l2``)."""
    if metric not in ("cosine", "l2") or k < 1:
        raise ValueError(f"metric {metric}, k {k}")
    given = points.schema[vector_col].dataType
    kind = "float" if given.simpleString() == "array<float>" else "double"      # exact in either
    rows = cut_lineage(usable_vectors(points, id_col, vector_col, metric, kind))
    n, least, most = rows.agg(F.count(F.lit(1)), F.min(F.size("vec")), F.max(F.size("vec"))).first()
    if least != most:
        raise ValueError(f"vectors of {least} to {most} components")
    classes = rows.groupBy("vec").agg(F.min("id").alias("rep"))
    v = F.col("vec")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    classes = cut_lineage(classes.select("rep", "vec", (length if metric == "cosine" else F.lit(1.0)).alias("length")))
    m = classes.count()
    if not m:
        empty = rows.select("id", F.lit(1).alias("rank"), F.col("id").alias("neighbour_id"), F.lit(0.0).alias("distance"))
        return Neighbours(empty, 0.0, 0)
    found, measures = _search(classes, m, k, metric)
    if m == n:
        return Neighbours(found.select(F.col("rep").alias("id"), "rank", F.col("near").alias("neighbour_id"), "distance"), *measures)
    found = cut_lineage(found)
    held = cut_lineage(rows.join(classes.select("rep", "vec"), "vec").select("id", "rep"))      # a hot class: split by AQE
    first = Window.partitionBy("rep").orderBy("id")
    members = held.withColumn("_r", F.row_number().over(first)).filter(F.col("_r") <= k + 1).select(F.col("rep").alias("near"), "id")
    each = (found.join(members, "near").select("rep", "id", "distance")
            .unionByName(members.select(F.col("near").alias("rep"), "id", F.lit(0.0).alias("distance"))))
    lists = cut_lineage(_top(each, "rep", "id", k + 1, "_r").select("rep", F.col("id").alias("neighbour_id"), "distance"))
    out = _top(held.join(lists, "rep").filter(F.col("id") != F.col("neighbour_id")), "id", "neighbour_id", k)
    return Neighbours(out.select("id", "rank", "neighbour_id", "distance"), *measures)


def all_pairs_topk(points: DataFrame, k: int = 10, id_col: str = "id", vector_col: str = "vector",
                   metric: str = "cosine") -> DataFrame:
    """(id, rank, neighbour_id, distance) of the k nearest other rows of every row."""
    return nearest_neighbours(points, k, id_col, vector_col, metric).rows
