"""Best-fit packing of documents into fixed-length token sequences, by linear grouping.

Documents longer than a sequence are cut into full pieces and a rest; all else stays whole.
Piece lengths are whole numbers up to the capacity, so their histogram is bounded by it
(at most 2048 rows at 2048 tokens), whatever the number of documents, and the packing is planned
on that histogram alone:

1. *Linear grouping*: the lengths above ``small`` (a third of the capacity) are put in order and cut into groups of
   equal cardinality; every length of a group is rounded up to its largest.
2. *Few-size configurations*: the multiplicities of the ways to fill a sequence with rounded
   lengths are optimised by column generation (a revised simplex over one row a group,
   priced by a knapsack); fractions are rounded down and the rest is packed best-fit.
3. *Substitution*: actual documents take the rounded places, group by group.
4. *Best fit*: the small ones go to the fullest sequence that still has room.

The plan is a run-length code: (place, how many sequences, where each length's documents
start), a few rows a length. On the cluster every piece gets its number among the pieces of
its length (salted, so that a length held by a third of all rows is numbered by many tasks)
and looks its place up in the plan.

Defined results. A null or empty text is one piece of one token (the closing id 0). Rows that
repeat a ``doc_id`` are packed each by itself. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import bucketed_number, small_batches, write_once
from playstats.llm.tokens import encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 0
GROUPS = 800


# ---- pieces -----------------------------------------------------------------------------

def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document's pieces."""

    def cut(batches):
        enc = encoder(tokenizer_path)
        end = np.asarray([END_ID], dtype="<u4").tobytes()
        for batch in small_batches(batches):
            out = ([], [], [], [], [])
            texts = enc.encode([t or "" for t in batch.column(1).to_pylist()])
            for doc, ids in zip(batch.column(0).to_pylist(), texts):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    for col, v in zip(out, (doc, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- plan on the histogram (lengths -> counts) ------------------------------------------

def linear_groups(counts: dict[int, int], small: int, groups: int) -> list[tuple[int, list[int]]]:
    """(rounded length, lengths from the largest down) of equal-cardinality groups of the large lengths.

    A length with more documents than a group's share is a group of its own.
    """
    large = sorted((s for s in counts if s > small), reverse=True)
    share = sum(counts[s] for s in large) / max(1, groups)
    out: list[tuple[int, list[int]]] = []
    held = 0.0
    for s in large:
        if not out or held >= share or counts[s] >= share:
            out.append((s, []))
            held = 0
        out[-1][1].append(s)
        held += counts[s]
    return out


def _best_fill(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable way to fill a sequence with any number of each size (knapsack).

    Room is handled in blocks as wide as the smallest size, which depend on earlier blocks only.
    """
    least = int(sizes.min())
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    pad = int(sizes.max())
    held = np.concatenate([np.full(pad, -np.inf), best])      # room below 0 fits nothing
    for lo in range(least, capacity + 1, least):
        room = np.arange(lo, min(lo + least, capacity + 1))
        value = held[pad + room[:, None] - sizes[None, :]] + worth[None, :]
        pick = value.argmax(axis=1)
        top = value[np.arange(len(room)), pick]
        run = np.maximum.accumulate(np.maximum(top, best[lo - 1]))
        better = top >= run - 1e-12
        best[room], last[room] = run, np.where(better & (top > 0), pick, -1)
        held[pad + room] = run
    use, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            use[last[c]] += 1
            c -= int(sizes[last[c]])
    return float((worth * use).sum()), use


# The planner runs in the driver process beside the JVM. It uses element-wise numpy only: the
# threads of a BLAS library do not survive the fork that starts the JVM, and its calls can hang.

def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """matrix x vector over the vector's entries that are not 0."""
    at = np.flatnonzero(vector)
    return (matrix[:, at] * vector[at]).sum(axis=1)


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination with row exchanges."""
    n = len(matrix)
    work = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        p = i + int(np.abs(work[i:, i]).argmax())
        if p != i:
            work[[i, p]] = work[[p, i]]
        work[i] /= work[i, i]
        rows = np.flatnonzero(work[:, i])
        rows = rows[rows != i]
        work[rows] -= work[rows, i][:, None] * work[i]
    return work[:, n:].copy()


def _multiples(basis: np.ndarray, inverse: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x, inverse) with basis x = d; the inverse is made anew where its updates have lost precision."""
    x = _times(inverse, d)
    off = d - _times(basis, x)
    if np.abs(off).max() > 1e-7 * max(1.0, np.abs(d).max()):
        inverse = _inverse(basis)
        x = _times(inverse, d)
        off = d - _times(basis, x)
    return x + _times(inverse, off), inverse


def configurations(sizes: list[int], need: list[int], capacity: int, gap: float = 2e-4,
                   rounds: int = 5000) -> list[tuple[tuple[int, ...], int]]:
    """(number of each size, sequences) that cover ``need`` with near as few sequences as can be.

    Column generation: the basis starts with one-size fillings; the filling with the best
    reduced cost enters until the solution is within ``gap`` of the bound. ``rounds`` only stops
    the polishing; any basis is a valid packing. Fractions are rounded down; the remainder goes
    to best fit.
    """
    if not sizes:
        return []
    sz, d = np.asarray(sizes), np.asarray(need, dtype=float)
    fits = np.asarray([float(capacity // s) for s in sizes])
    basis, inverse, x = np.diag(fits), np.diag(1 / fits), None
    for i in range(rounds):
        if i % 100 == 0:
            x, inverse = _multiples(basis, inverse, d)
        gain, col = _best_fill(sz, np.maximum(inverse.sum(axis=0), 0), capacity)
        if gain <= 1 + gap:
            break
        step = _times(inverse, col)
        able = step > 1e-9
        if not able.any():
            break
        ratio = np.where(able, np.maximum(x, 0) / np.where(able, step, 1), np.inf)
        r = int(ratio.argmin())
        basis[:, r] = col
        row = inverse[r] / step[r]
        moved = np.flatnonzero(step)
        inverse[moved] -= step[moved][:, None] * row
        inverse[r] = row
        x = x - step * ratio[r]
        x[r] = ratio[r]
    x, _ = _multiples(basis, inverse, d)
    out, left = [], np.asarray(need, dtype=np.int64)
    for j in np.argsort(-x):
        col = np.maximum(basis[:, j].round().astype(np.int64), 0)
        m = int(min([int(x[j] + 1e-9), *(left[col > 0] // col[col > 0])], default=0)) if x[j] >= 1 else 0
        if m > 0 and col.any():
            out.append((tuple(int(v) for v in col), m))
            left -= m * col
    return out


class _Runs:
    """Sequences as runs of equal shape, by free room."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.room: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def add(self, shape: tuple[int, ...], n: int) -> None:
        if n > 0:
            self.room[self.capacity - sum(shape)].append((shape, n))

    def best_fit(self, size: int, n: int) -> None:
        """Put ``n`` pieces of ``size`` one after another into the fullest sequence with room."""
        while n:
            fits = [r for r, runs in self.room.items() if r >= size and runs]
            if not fits:
                per = self.capacity // size
                self.add((size,) * per, n // per)
                if n % per:
                    self.add((size,) * (n % per), 1)
                return
            r = min(fits)
            shape, m = self.room[r].pop()
            per = r // size          # a sequence stays the fullest that fits until it is full
            take = min(m, n // per)
            if take:
                self.add(shape + (size,) * per, take)
                n -= take * per
                if m > take:
                    self.room[r].append((shape, m - take))
            else:
                self.add(shape + (size,) * n, 1)
                if m > 1:
                    self.room[r].append((shape, m - 1))
                n = 0


def plan_packing(counts: dict[int, int], capacity: int, groups: int = GROUPS,
                 small: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a sequence, number of such sequences) for a histogram of lengths."""
    small = capacity // 3 if small is None else small
    left = {s: n for s, n in counts.items() if n > 0}
    runs = _Runs(capacity)
    if left.get(capacity):
        runs.add((capacity,), left.pop(capacity))
    grouped = linear_groups(left, small, groups)
    # a run of each group's documents in order, largest first: the places of a configuration
    # take the next ones, so the shapes change only where a length runs out
    queue = [[[s, left[s]] for s in members] for _, members in grouped]
    sizes = [g for g, _ in grouped]
    need = [sum(left[s] for s in members) for _, members in grouped]
    for use, m in configurations(sizes, need, capacity):
        places = [j for j, k in enumerate(use) for _ in range(k)]
        while m:
            heads, at = [], defaultdict(int)
            for j in places:      # the places of one group share its queue
                heads.append(j)
                at[j] += 1
            n = m
            for j, k in at.items():
                # one length fills all k places of the group where it can
                head = queue[j][0]
                n = min(n, head[1] // k) if head[1] >= k else min(n, 1)
            n = max(n, 1)
            shape = []
            for j, k in at.items():
                want = k * n
                if queue[j][0][1] >= want:
                    shape += [queue[j][0][0]] * k
                    queue[j][0][1] -= want
                else:             # n == 1: the places span two or more lengths
                    for _ in range(k):
                        shape.append(queue[j][0][0])
                        queue[j][0][1] -= 1
                        if queue[j][0][1] == 0:
                            queue[j].pop(0)
                if queue[j] and queue[j][0][1] == 0:
                    queue[j].pop(0)
            runs.add(tuple(shape), n)
            m -= n
    rest = {s: n for q in queue for s, n in q if n > 0}
    rest.update({s: n for s, n in left.items() if s <= small})
    for s in sorted(rest, reverse=True):
        runs.best_fit(s, rest[s])
    return [run for rs in runs.room.values() for run in rs]


def _segments(plan: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """length -> (first number, first sequence, offset) arrays of the plan's places."""
    cursor: dict[int, int] = defaultdict(int)
    segs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    first = 0
    for shape, n in plan:
        at = 0
        for s in shape:
            segs[s].append((cursor[s], first, at))
            cursor[s] += n
            at += s
        first += n
    return {s: tuple(np.asarray(c, dtype=np.int64) for c in zip(*v)) for s, v in segs.items()}


def place_pieces(pieces: DataFrame, capacity: int = 2048, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (written once; with ``length`` up to ``capacity``) plus sequence_id and offset."""
    hist = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not hist:
        return pieces.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    segs = _segments(plan_packing(hist, capacity, groups))     # bounded by the capacity, not by the rows
    shared = pieces.sparkSession.sparkContext.broadcast(segs)
    numbered = bucketed_number(pieces, "length", hist, ["doc_id", "piece"], ["doc_id", "piece", "ids_crc32"], "_pk_n")
    names = pieces.columns
    schema = pa.schema([("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches):
        segs = shared.value
        for batch in batches:
            length, number = (batch.column(names_in.index(c)).to_numpy() for c in ("length", "_pk_n"))
            seq, off = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for s in np.unique(length):
                rows = np.nonzero(length == s)[0]
                start, first, at = segs[int(s)]
                i = np.searchsorted(start, number[rows], side="right") - 1
                seq[rows], off[rows] = first[i] + number[rows] - start[i], at[i]
            yield pa.RecordBatch.from_arrays([*(batch.column(names_in.index(c)) for c in names), pa.array(seq), pa.array(off)],
                                             [*names, *schema.names])

    names_in = numbered.columns
    return numbered.mapInArrow(place, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
                               + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text", groups: int = GROUPS) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = public_tokenizers.path(TOKENIZER)
    pieces = write_once(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces")
    return place_pieces(pieces, capacity, groups)
