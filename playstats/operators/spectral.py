"""Spectral layout of a weighted neighbour graph (M4).

The coordinates of a node are its entries in the second and third eigenvectors of
``A = D^-1/2 W D^-1/2``, each connected component by itself (a graph in several parts has no joint ones).

Nodes are dealt by hash to parts; a part holds its nodes' edges as arrays, in one row of the table of parts, which stays where
it is. What moves are vectors: for a product each part sends each other part the values of the nodes which that one's edges lead to.
A round is

1. *filter*: a Chebyshev polynomial of A, ``DEGREE`` products in one job; a product is one shuffle.
   The polynomial damps the part of the spectrum below the block's smallest eigenvalue;
2. *Rayleigh-Ritz*: the block's inner products are summed by component (a b x b table each), and the small
   eigenproblem of every component is solved in a task, not in the driver;
3. *stop rule*: the largest residual ``|A v - lambda v|`` of the wanted vectors over all components. If it is not
   below ``tolerance`` after ``rounds`` rounds an error is raised: an unconverged layout is never returned.

A product shuffles a node's values once for each part that needs them, so there are few parts: ``PARTS``,
more where a part would pass ``PART`` edges. ``_matrix`` and ``_product`` are the same product on rows, which tests hold it against.

The components are labelled on what is left of the edges when each part has joined up its own: a row a node and part.

Every state is written to the shared folder, so lost executors read files again.

Defined results. Edges must be symmetric; repeated ones add up; those without positive weight and loops are
left out. A component of fewer than ``dims + 1`` nodes has coordinates 0 where it has no vector left. Each vector's
sign makes its entry of largest size positive (the smallest node among equals at 9 places).
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.session import cut_lineage

DEGREE = 8
GUARDS = 6          # vectors beyond the wanted ones
PARTS = 6           # parts of the edges, at least
PART = 4_000_000    # edges a part
_BLOCK = "part int, nodes binary, root binary, starts binary, place binary, weight binary, ahead binary, owners binary, counts binary"
_TALK = "part int, sender int, data binary"       # what a part sends to another; to itself, all it has


def component_labels(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the symmetric edges (src, dst); comp is its smallest node.

    Each round a node takes the smallest label around it, then the label of its label.
    """
    around = edges.select("src", "dst")
    labels = cut_lineage(around.groupBy(F.col("src").alias("node")).agg(F.least(F.col("node"), F.min("dst")).alias("comp")))
    while True:
        low = (around.join(labels, F.col("dst") == F.col("node")).groupBy("src").agg(F.min("comp").alias("low"))
               .join(labels, F.col("src") == F.col("node")).select("node", F.least("low", "comp").alias("next"), "comp"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("of"))
        new = cut_lineage(low.join(jump, "next").select("node", F.least("next", "of").alias("new"), "comp"))
        labels = new.select("node", F.col("new").alias("comp"))
        if not new.filter("new <> comp").limit(1).count():
            return labels


def _matrix(edges: DataFrame) -> DataFrame:
    """(src, dst, a, own): A's entries, and a loop with own = 1 and a = 0 at every node."""
    w = (edges.filter((F.col("weight") > 0) & (F.col("src") != F.col("dst")))
         .groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    w = cut_lineage(w)
    degree = cut_lineage(w.groupBy("src").agg(F.sum("weight").alias("d")))
    a = (w.join(degree, "src").join(degree.select(F.col("src").alias("dst"), F.col("d").alias("e")), "dst")
         .select("src", "dst", (F.col("weight") / F.sqrt(F.col("d") * F.col("e"))).alias("a"), F.lit(0.0).alias("own")))
    return cut_lineage(a.unionByName(degree.select("src", F.col("src").alias("dst"), F.lit(0.0).alias("a"), F.lit(1.0).alias("own"))))


def _product(matrix: DataFrame, state: DataFrame, b: int, factor: float, parts: int, last: bool = False) -> DataFrame:
    """The next Chebyshev vectors of ``state`` (node, comp, mid, half, y*, p*); with ``last`` A y beside y."""
    own, a = F.col("own"), F.col("a")
    keep = [F.max(F.when(own == 1, F.col(c))).alias(c) for c in ("comp", "mid", "half")]
    y, p = [F.col(f"y{i}") for i in range(b)], [F.col(f"p{i}") for i in range(b)]
    if last:
        new = [F.sum(a * y[i]).alias(f"z{i}") for i in range(b)] + [F.sum(own * y[i]).alias(f"y{i}") for i in range(b)]
    else:
        new = [F.sum((a - own * F.col("mid")) * y[i] * (factor / F.col("half")) - own * p[i]).alias(f"y{i}") for i in range(b)]
        new += [F.sum(own * y[i]).alias(f"p{i}") for i in range(b)]
    return matrix.join(state, F.col("dst") == F.col("node")).coalesce(parts).groupBy(F.col("src").alias("node")).agg(*keep, *new)


def _keys(spark, parts: int) -> list[int]:
    """A key for each of ``parts`` partitions that hash partitioning deals to it."""
    key = F.col("id").cast("int")
    at = F.pmod(F.hash(key), F.lit(parts))
    rows = spark.range(0, 64 * parts, 1, 1).groupBy(at.alias("at")).agg(F.min(key).alias("key")).orderBy("at").collect()      # a row a part
    return [r["key"] for r in rows]


def _joined(src: np.ndarray, dst: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the ``n`` nodes that each hangs together with by the edges, sorted by src."""
    label = np.arange(n)
    heads = np.flatnonzero(np.r_[True, src[1:] != src[:-1]]) if len(src) else np.empty(0, int)
    while True:
        low = label.copy()
        if len(src):
            low[src[heads]] = np.minimum(low[src[heads]], np.minimum.reduceat(label[dst], heads))
            np.minimum.at(low, dst, low[src])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _owner(node: str, keys: list[int]):
    return F.element_at(F.array(*map(F.lit, keys)), (F.pmod(F.xxhash64(node, F.lit(11)), F.lit(len(keys))) + 1).cast("int"))


def _packed(edges: DataFrame, keys: list[int]) -> DataFrame:
    """A row a part: its nodes, its edges by node, and ``ahead``, the nodes they lead to, by the part that owns these.

    ``leaf`` and ``stem`` are edges that hang together what the part's edges do.
    """
    owner = [_owner(c, keys).alias(n) for c, n in (("src", "part"), ("dst", "owner"))]

    def pack(key, table):
        src, dst, weight, owner = (table[c].to_numpy() for c in ("src", "dst", "weight", "owner"))
        order = np.lexsort((dst, owner, src))
        src, dst, weight, owner = src[order], dst[order], weight[order], owner[order]
        first = np.flatnonzero(np.r_[True, (src[1:] != src[:-1]) | (dst[1:] != dst[:-1])])
        src, dst, weight, owner = src[first], dst[first], np.add.reduceat(weight, first), owner[first]
        starts = np.flatnonzero(np.r_[True, src[1:] != src[:-1]])
        nodes = src[starts]
        _, one, place = np.unique(dst, return_index=True, return_inverse=True)
        turn = np.lexsort((dst[one], owner[one]))
        rank = np.empty(len(one), np.int32)
        rank[turn] = np.arange(len(one), dtype=np.int32)
        ahead, held = dst[one][turn], owner[one][turn]
        owners, counts = np.unique(held, return_counts=True)
        all_ = np.union1d(nodes, ahead)
        root = all_[_joined(np.searchsorted(all_, src), np.searchsorted(all_, dst), len(all_))]
        row = {"part": pa.array([key[0].as_py()], pa.int32())}
        for name, x in (("nodes", nodes), ("root", 1 / np.sqrt(np.add.reduceat(weight, starts))), ("starts", starts), ("place", rank[place]), ("weight", weight),
                        ("ahead", ahead), ("owners", owners.astype(np.int64)), ("counts", counts), ("leaf", all_[root != all_]), ("stem", root[root != all_])):
            row[name] = pa.array([x.tobytes()], pa.binary())
        return pa.table(row)

    return cut_lineage(edges.select(*owner, "src", "dst", "weight").repartition(len(keys), "part").groupBy("part").applyInArrow(pack, f"{_BLOCK}, leaf binary, stem binary"))


def _stars(packed: DataFrame) -> DataFrame:
    """(src, dst), both ways, of the edges that each part leaves for the labels."""
    def unpack(batches):
        for batch in batches:
            for leaf, stem in zip(batch["leaf"], batch["stem"]):
                for x, y in ((leaf, stem), (stem, leaf)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(v.as_py(), np.int64)) for v in (x, y)], names=["src", "dst"])

    return packed.select("leaf", "stem").mapInArrow(unpack, "src long, dst long")


def _talk(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    part, sender, data = zip(*rows) if rows else ((), (), ())
    return pa.table({"part": pa.array(part, pa.int32()), "sender": pa.array(sender, pa.int32()), "data": pa.array(data, pa.binary())})


class _Part:
    """A part's row as arrays."""

    def __init__(self, block: pa.Table):
        row = {c: block[c][0].as_py() for c in block.column_names}
        kind = {"root": np.float64, "weight": np.float64, "place": np.int32}
        self.key = row["part"]
        for c in block.column_names[1:]:
            setattr(self, c, np.frombuffer(row[c], kind.get(c, np.int64)))
        if "sends" in row:
            self.sends = np.split(self.sends, np.cumsum(self.lengths)[:-1]) if len(self.lengths) else []

    def own(self, came: pa.Table, width: int) -> np.ndarray:
        """The ``width`` rows of values that this part sent to itself."""
        data = came["data"][came["sender"].to_pylist().index(self.key)].as_py()
        return np.frombuffer(data, count=width * len(self.nodes)).reshape(width, -1)

    def spread(self, values: np.ndarray, b: int) -> pa.Table:
        """``values``, of which the first ``b`` rows go to the parts that ask; what such a one asks of nodes without edges here is 0."""
        scaled = np.c_[values[:b] * self.root, np.zeros(b)]
        out = {int(to): scaled[:, at].tobytes() for to, at in zip(self.takers, self.sends)}
        mine = out.get(self.key, b"")      # a part may hold both ends of an edge
        out[self.key] = values.tobytes() + mine
        return _talk([(to, self.key, data) for to, data in out.items()])

    def times(self, came: pa.Table, b: int, width: int) -> np.ndarray:
        """A times the ``b`` vectors of which all parts have sent theirs."""
        near = np.zeros((b, len(self.ahead)))
        ends = dict(zip(self.owners.tolist(), zip((np.cumsum(self.counts) - self.counts).tolist(), self.counts.tolist())))
        for sender, data in zip(came["sender"].to_pylist(), came["data"]):
            if sender in ends:
                at, n = ends[sender]
                skip = 8 * width * len(self.nodes) if sender == self.key else 0
                near[:, at:at + n] = np.frombuffer(data.as_py(), offset=skip).reshape(b, n)
        return np.stack([np.add.reduceat(self.weight * v[self.place], self.starts) for v in near]) * self.root


def _parts(packed: DataFrame, n: int) -> DataFrame:
    """The table of parts, each with what it sends to whom, kept where ``n`` partitions by ``part`` are."""
    def ask(batches):
        for batch in batches:
            for key, ahead, owners, counts in zip(*(batch[c] for c in ("part", "ahead", "owners", "counts"))):
                ids = np.split(np.frombuffer(ahead.as_py(), np.int64), np.cumsum(np.frombuffer(counts.as_py(), np.int64))[:-1])
                to = np.frombuffer(owners.as_py(), np.int64).tolist()
                yield from _talk([(o, key.as_py(), x.tobytes()) for o, x in zip(to, ids)]).to_batches()

    def answer(key, block, asked):
        if not block.num_rows:
            return empty
        nodes = np.frombuffer(block["nodes"][0].as_py(), np.int64)
        sends = []
        for x in asked["data"]:
            ids = np.frombuffer(x.as_py(), np.int64)
            at = np.minimum(np.searchsorted(nodes, ids), len(nodes) - 1)
            sends.append(np.where(nodes[at] == ids, at, len(nodes)))
        for name, x in (("takers", asked["sender"].to_numpy().astype(np.int64)), ("lengths", np.array([len(x) for x in sends], np.int64)),
                        ("sends", np.concatenate(sends or [np.empty(0, np.int64)]).astype(np.int64))):
            block = block.append_column(name, pa.array([x.tobytes()], pa.binary()))
        return block

    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = f"{_BLOCK}, takers binary, lengths binary, sends binary"
    empty = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]).empty_table()
    blocks = packed.drop("leaf", "stem")
    asked = packed.select("part", "ahead", "owners", "counts").mapInArrow(ask, _TALK)
    full = cut_lineage(blocks.groupBy("part").cogroup(asked.groupBy("part")).applyInArrow(answer, schema))
    parts = full.repartition(n, "part").sortWithinPartitions("part").persist()
    parts.count()       # from here on plans know how it is dealt
    return parts


def _each(parts: DataFrame, came: DataFrame, turn, schema: str = _TALK) -> DataFrame:
    """``turn`` of every part (a :class:`_Part`) and the rows of ``came`` for it, a table."""
    def run(key, block, rows):
        return turn(_Part(block), rows) if block.num_rows else none

    none = pa.schema([(c, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}.get(k, pa.float64()))
                      for c, k in (f.split() for f in schema.split(", "))]).empty_table()
    return parts.groupBy("part").cogroup(came.groupBy("part")).applyInArrow(run, schema)


def _state(y: np.ndarray, mid, half, comp: np.ndarray) -> np.ndarray:
    """What a part holds of its nodes between two products: y, the vectors before (none yet), mid, half, and comp's bits."""
    return np.concatenate([y, np.zeros_like(y), [np.broadcast_to(mid, comp.shape), np.broadcast_to(half, comp.shape), comp.view(np.float64)]])


def _start(parts: DataFrame, labels: DataFrame, keys: list[int], b: int) -> DataFrame:
    """The first vectors, by hash of the node, as sent by every part."""
    start = [(F.xxhash64("node", F.lit(i)) / float(2 ** 63)).alias(f"y{i}") for i in range(b)]

    def turn(part, rows):
        at = np.searchsorted(part.nodes, rows["node"].to_numpy())
        known = (at < len(part.nodes)) & (part.nodes[np.minimum(at, len(part.nodes) - 1)] == rows["node"].to_numpy())
        order = np.flatnonzero(known)[np.argsort(at[known])]
        y = np.stack([rows[f"y{i}"].to_numpy()[order] for i in range(b)])
        return part.spread(_state(y, -0.5, 0.5, rows["comp"].to_numpy()[order]), b)

    return _each(parts, labels.select(_owner("node", keys).alias("part"), "node", "comp", *start), turn)


def _step(parts: DataFrame, came: DataFrame, b: int, factor: float, last: bool = False) -> DataFrame:
    """The next Chebyshev vectors of what every part has sent; with ``last`` y, A y and comp, for the part itself."""
    width = 2 * b + 3

    def turn(part, rows):
        own = part.own(rows, width)
        y, p, mid, half = own[:b], own[b:2 * b], own[2 * b], own[2 * b + 1]
        z = part.times(rows, b, width)
        if last:
            return _talk([(part.key, part.key, np.concatenate([y, z, own[-1:]]).tobytes())])
        return part.spread(np.concatenate([(z - mid * y) * (factor / half) - p, y, own[2 * b:]]), b)

    return _each(parts, came, turn)


def _dots(both: DataFrame, b: int) -> DataFrame:
    """(part, comp, dots): nodes and inner products yy, yz, zz of y and z = A y by component, a part's share of them."""
    pairs = [(n, i, j) for n in ("yy", "yz", "zz") for i in range(b) for j in range(i, b)]

    def dots(batches):
        for batch in batches:
            for key, data in zip(batch["part"], batch["data"]):
                own = np.frombuffer(data.as_py()).reshape(2 * b + 1, -1)
                comp = own[-1].copy().view(np.int64)
                order = np.argsort(comp, kind="stable")
                comp, own = comp[order], own[:, order]
                heads = np.flatnonzero(np.r_[True, comp[1:] != comp[:-1]])
                of = {"y": own[:b], "z": own[b:2 * b]}
                sums = [np.diff(np.r_[heads, len(comp)]).astype(float), *[np.add.reduceat(of[n[0]][i] * of[n[1]][j], heads) for n, i, j in pairs]]
                ends = pa.array(np.arange(len(heads) + 1, dtype=np.int32) * len(sums))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(heads), key.as_py(), np.int32)), pa.array(comp[heads]),
                                                  pa.ListArray.from_arrays(ends, pa.array(np.stack(sums, axis=1).ravel()))], names=["part", "comp", "dots"])

    return cut_lineage(both.select("part", "data").mapInArrow(dots, "part int, comp long, dots array<double>"))


def _turned(parts: DataFrame, both: DataFrame, shares: DataFrame, solved: DataFrame, b: int, last: int = 0) -> DataFrame:
    """The block turned into the eigenvectors found, as sent by every part; with ``last`` (node, comp, y*) of so many of them."""
    found = shares.select("part", "comp").join(solved.select("comp", "g", "low"), "comp")

    def turn(part, rows):
        own = part.own(rows.filter(rows["sender"].is_valid()), 2 * b + 1)
        comp = own[-1].copy().view(np.int64)
        got = rows.filter(rows["comp"].is_valid()).sort_by("comp")
        at = np.searchsorted(got["comp"].to_numpy(), comp)
        g = np.concatenate([c.flatten().to_numpy() for c in got["g"].chunks]).reshape(-1, b, b)
        y = np.stack([sum(own[i] * g[at, i, j] for i in range(b)) for j in range(last or b)])
        if last:
            return pa.table({"node": part.nodes, "comp": comp, **{f"y{i}": v for i, v in enumerate(y)}})
        cut = np.maximum(got["low"].to_numpy(), -0.5)[at]
        return part.spread(_state(y, (cut - 1) / 2, (cut + 1) / 2, comp), b)

    came = both.unionByName(found, allowMissingColumns=True)
    if last:
        return _each(parts, came, turn, "node long, comp long, " + ", ".join(f"y{i} double" for i in range(last)))
    return _each(parts, came, turn)


def _ritz(shares: DataFrame, b: int, wanted: int) -> DataFrame:
    """(comp, g, low, residual): block coefficients of the eigenvectors of each component's b x b problem."""
    upper = np.triu_indices(b)

    def full(values):
        m = np.zeros((b, b))
        m[upper] = m.T[upper] = values
        return m

    def solve(comp, dots):
        nodes, (yy, yz, zz) = dots[0], (full(x) for x in dots[1:].reshape(3, -1))
        size = 1 / np.sqrt(np.maximum(np.diag(yy), 1e-300))
        value, q = np.linalg.eigh(yy * size[:, None] * size)
        fine = value > 1e-12 * value[-1]              # a small component spans fewer than b vectors
        basis = size[:, None] * q[:, fine] / np.sqrt(value[fine])
        theta, turn = np.linalg.eigh(basis.T @ yz @ basis)
        g = (basis @ turn)[:, ::-1]
        theta = theta[::-1]
        square = np.einsum("ij,ik,kj->j", g, zz, g) - 2 * theta * np.einsum("ij,ik,kj->j", g, yz, g) \
            + theta ** 2 * np.einsum("ij,ik,kj->j", g, yy, g)
        residual = float(np.sqrt(np.maximum(square[:wanted], 0)).max())
        rank = len(theta)
        full_g = np.zeros((b, b))
        full_g[:, :rank] = g
        # nodes == rank: the block spans all of the component
        return comp, full_g.ravel(), float(theta[-1]) if rank == b else 0.0, 0.0 if nodes <= rank else residual

    def run(batches):
        rest, sums = np.empty(0, np.int64), np.empty((0, 1 + 3 * len(upper[0])))
        for batch in chain(batches, [None]):
            if batch is not None:
                rest = np.concatenate([rest, batch["comp"].to_numpy()])
                sums = np.concatenate([sums, batch["dots"].flatten().to_numpy().reshape(batch.num_rows, -1)])
            if not len(rest):
                continue
            heads = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
            rest, sums = rest[heads], np.add.reduceat(sums, heads, axis=0)
            whole = len(rest) - (batch is not None)       # rows of the last may follow
            yield pd.DataFrame([solve(c, x) for c, x in zip(rest[:whole], sums[:whole])], columns=["comp", "g", "low", "residual"])
            rest, sums = rest[whole:], sums[whole:]

    def solved(batches):
        for pdf in run(batches):
            if len(pdf):
                yield pa.RecordBatch.from_pandas(pdf, schema=schema, preserve_index=False)

    schema = pa.schema([("comp", pa.int64()), ("g", pa.list_(pa.float64())), ("low", pa.float64()), ("residual", pa.float64())])
    by_comp = shares.select("comp", "dots").repartition("comp").sortWithinPartitions("comp")
    return by_comp.mapInArrow(solved, "comp long, g array<double>, low double, residual double")


def spectral_layout(edges: DataFrame, dims: int = 2, tolerance: float = 1e-7, rounds: int = 60,
                    id_col: str = "node") -> DataFrame:
    """(``id_col``, x, y, ...): coordinates of every node of the symmetric edges (src, dst, weight)."""
    b = dims + 1 + GUARDS
    used = cut_lineage(edges.filter((F.col("weight") > 0) & (F.col("src") != F.col("dst"))).select(
        *[F.col(c).cast(kind).alias(c) for c, kind in (("src", "long"), ("dst", "long"), ("weight", "double"))]))
    keys = _keys(used.sparkSession, max(PARTS, -(-used.count() // PART)))
    packed = _packed(used, keys)
    labels = component_labels(cut_lineage(_stars(packed)))
    parts = _parts(packed, len(keys))
    came = _start(parts, labels, keys, b)
    for _ in range(rounds):
        for k in range(DEGREE):
            came = _step(parts, came, b, 1.0 if k == 0 else 2.0)
        both = cut_lineage(_step(parts, came, b, 1.0, last=True))
        shares = _dots(both, b)
        solved = cut_lineage(_ritz(shares, b, dims + 1))
        worst = solved.agg(F.max("residual")).first()[0]
        if worst is None or worst <= tolerance:
            break
        came = _turned(parts, both, shares, solved, b)
    else:
        parts.unpersist()
        raise RuntimeError(f"spectral layout not converged after {rounds} rounds: residual {worst:.3g} > {tolerance:.3g}")
    state = cut_lineage(_turned(parts, both, shares, solved, b, last=dims + 1))
    parts.unpersist()
    names = ["x", "y"][:dims] + [f"axis{i + 1}" for i in range(2, dims)]
    tops = [F.max_by(F.signum(f"y{i + 1}"), F.struct(F.round(F.abs(f"y{i + 1}"), 9), -F.col("node"))).alias(f"s{i}") for i in range(dims)]
    signs = state.groupBy("comp").agg(*tops)
    return state.join(signs, "comp").select(F.col("node").alias(id_col), *[
        (F.col(f"y{i + 1}") * F.col(f"s{i}")).alias(n) for i, n in enumerate(names)])
