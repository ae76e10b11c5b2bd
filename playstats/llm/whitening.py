"""Embedding whitening by pivoted Cholesky and one-sided Jacobi.

Each vector entry c becomes the whole number x = floor(1024 * c) + 100000. Over all vectors:

1. one pass sums the count n and the per-dimension sums S, exactly;
2. one pass sums the centred scatter: every entry is centred on its mean first, then multiplied;
   each task adds its own rows up and hands on one d x d table;
3. on the d x d scatter alone: Cholesky with pivoting (the largest remaining diagonal first) gives a
   lower triangular factor L with scatter = L L'; one-sided Jacobi rotates pairs of L's columns until all
   are orthogonal. The rotated columns' squared norms are the scatter's eigenvalues, the normalised
   columns its eigenvectors. Small eigenvalues keep their relative accuracy, which a solver on the
   scatter itself loses;
4. one pass projects every row on the first components; one more measures the covariance of what
   came out, so ``identity_error`` is that of the returned numbers.

The d x d work is bounded by the vectors' length. It uses element-wise numpy only, as the driver
process's BLAS threads may have been lost in the fork that started the JVM.

Defined results. Rows whose vector is null, empty, or holds null, non-finite or larger entries than a
double can hold exactly after scaling (2^53) are dropped. Rows without id and rows that repeat an id
each count and are returned. Vectors of different lengths are whitened each length by itself. A component
without variance (fewer distinct vectors than components) has null ``whitened``, ``explained`` 0, and no part in
``identity_error``, which is 0 if no component has variance. ``deviation`` is exact, and null beyond
64 bits. Other columns are not read, so
their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import write_once

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
RANK_TOLERANCE = 1e-13      # of the largest diagonal entry; what is left below it is rounding
SWEEPS = 60


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, dim, x) of every usable row."""
    v = F.col("v")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2 ** 53 // SCALE)))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .filter(v.isNotNull() & (F.size(v) > 0) & F.coalesce(fine, F.lit(False)))
            .select("vec_id", F.size("v").alias("dim"), F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x")))


def _by_dim(pdf: pd.DataFrame):
    for dim, part in pdf.groupby("dim"):
        yield int(dim), part, np.stack(part["x"].to_numpy())


def column_sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Vector length -> (n, S): exact. Entries are added as high and low 32 bits, which cannot overflow."""

    def add_up(frames):
        total = {}
        for pdf in frames:
            for dim, _, x in _by_dim(pdf):
                part = np.stack([np.full(dim, len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
                total[dim] = total.get(dim, 0) + part
        for dim, (n, high, low) in total.items():
            yield pd.DataFrame({"dim": dim, "i": np.arange(dim), "n": n, "high": high, "low": low})

    parts = vectors.select("dim", "x").mapInPandas(add_up, "dim int, i int, n long, high long, low long")
    sums = parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("dim", "i").collect():      # one row a position of each vector length
        out.setdefault(r["dim"], (r["n"], []))[1].append((r["high"] << 32) + r["low"])
    return out


def centred_scatter(vectors: DataFrame, means: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Vector length -> sum of (x - mean)(x - mean)' over its vectors."""

    def add_up(frames):
        total = {}
        for pdf in frames:
            for dim, _, x in _by_dim(pdf):
                y = x - means[dim]
                total[dim] = total.get(dim, 0.0) + y.T @ y
        for dim, s in total.items():
            i, j = np.triu_indices(dim)
            yield pd.DataFrame({"dim": dim, "i": i, "j": j, "s": s[i, j]})

    cells = vectors.select("dim", "x").mapInPandas(add_up, "dim int, i int, j int, s double").groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))
    out = {dim: np.zeros((dim, dim)) for dim in means}
    for r in cells.collect():      # d (d + 1) / 2 rows a vector length
        out[r["dim"]][r["i"], r["j"]] = out[r["dim"]][r["j"], r["i"]] = r["s"]
    return out


def pivoted_cholesky(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(factor, order): ``scatter[order][:, order]`` is factor x factor'; lower trapezoidal, rank columns wide."""
    left = scatter.copy()
    n = len(left)
    order, columns = np.arange(n), []
    floor = RANK_TOLERANCE * max(float(left.diagonal().max(initial=0.0)), 0.0)
    for k in range(n):
        p = k + int(left.diagonal()[k:].argmax())
        if not left[p, p] > floor:
            break
        for a in (left, left.T, order[:, None], *(c[:, None] for c in columns)):
            a[[k, p]] = a[[p, k]]
        column = np.zeros(n)
        column[k:] = left[k:, k] / np.sqrt(left[k, k])
        column[k] = np.sqrt(left[k, k])
        left[k:, k:] -= column[k:, None] * column[None, k:]
        columns.append(column)
    return np.stack(columns, axis=1) if columns else np.zeros((n, 0)), order


def _rounds(m: int):
    """Every pair of ``m`` columns once, as rounds of disjoint pairs (a round-robin tournament)."""
    ring = list(range(m + m % 2))
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], ring[::-1]) if a < m and b < m]
        yield np.asarray([min(p) for p in pairs], int), np.asarray([max(p) for p in pairs], int)
        ring = [ring[0], ring[-1], *ring[1:-1]]


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times the rotations that make its columns orthogonal."""
    a = factor.copy()
    m = a.shape[1]
    if m < 2:
        return a
    rounding = np.finfo(float).eps * np.sqrt(len(a))      # of a cosine
    for _ in range(SWEEPS):
        worst = 0.0
        for p, q in _rounds(m):
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            cosine = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, float(cosine.max()))
            act = cosine > rounding
            if not act.any():
                continue
            p, q, x, y, xx, yy, xy = p[act], q[act], x[:, act], y[:, act], xx[act], yy[act], xy[act]
            zeta = (yy - xx) / (2 * xy)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if worst <= 4 * rounding:
            return a
    raise ArithmeticError(f"columns are not orthogonal after {SWEEPS} sweeps: cosine {worst:.3g}")


def eigen(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues by falling size, eigenvectors as columns) of the positive part of a scatter matrix."""
    factor, order = pivoted_cholesky(scatter)
    turned = one_sided_jacobi(factor)
    values = (turned * turned).sum(axis=0)
    by_size = np.argsort(-values, kind="stable")
    values, turned = values[by_size], turned[:, by_size]
    vectors = np.empty_like(turned)
    vectors[order] = turned / np.sqrt(values)
    return values, vectors


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """Vector length -> n, S, mean, components (d x k), eigenvalues of the covariance, its trace."""
    sums = column_sums(vectors)
    means = {dim: np.asarray([s / n for s in total]) for dim, (n, total) in sums.items()}
    out = {}
    for dim, scatter in centred_scatter(vectors, means).items():
        n, total = sums[dim]
        values, basis = eigen(scatter)
        k = min(components, dim)
        out[dim] = {"n": n, "sums": total, "mean": means[dim], "basis": basis[:, :k], "values": values[:k] / n,
                    "trace": float(scatter.trace()) / n, "width": k}
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, in whole numbers of any size where 64 bits may not do."""
    spread = max(abs(n * int(x[:, i].max()) - s) for i, s in enumerate(sums))
    spread = max(spread, max(abs(n * int(x[:, i].min()) - s) for i, s in enumerate(sums)))
    if spread * spread * len(sums) < 2 ** 63 and max(map(abs, sums)) < 2 ** 63:      # products wrap, differences fit
        y = n * x - np.asarray(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 2 ** 63 else None for d in exact]


def _project(vectors: DataFrame, fits: dict[int, dict]) -> DataFrame:
    def project(frames):
        for pdf in frames:
            for dim, part, x in _by_dim(pdf):
                f = fits[dim]
                y, rank = x - f["mean"], f["basis"].shape[1]
                w = (y @ f["basis"]) / np.sqrt(f["values"])
                deviation = _deviations(x, f["n"], f["sums"])
                yield pd.DataFrame({
                    "vec_id": part["vec_id"].astype("Int64"), "dim": dim, "n": f["n"],
                    "deviation": pd.array(deviation, dtype="Int64"),
                    "w": [[*r, *[None] * (f["width"] - rank)] for r in w.tolist()]})

    return vectors.mapInPandas(project, "vec_id long, dim int, n long, deviation long, w array<double>")


def _identity_errors(projected: DataFrame, fits: dict[int, dict]) -> dict[int, float]:
    """Vector length -> largest entry of the whitened rows' covariance minus the identity."""
    width = max(f["width"] for f in fits.values())
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    short = projected.select("dim", *[F.get("w", F.lit(i)).alias(f"w{i}") for i in range(width)])
    at = [f"w{i}" for i in range(width)]
    sums = short.groupBy("dim").agg(*[F.covar_pop(at[i], at[j]).alias(f"c{i}_{j}") for i, j in pairs])
    out = {}
    for r in sums.collect():
        rank = fits[r["dim"]]["basis"].shape[1]
        out[r["dim"]] = max((abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if j < rank), default=0.0)
    return out


def whiten(table: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each row and component."""
    vectors = write_once(whole_vectors(table, id_col, vector_col), "whiten-vectors")
    fits = fit_whitening(vectors, components)
    projected = write_once(_project(vectors, fits), "whiten-rows")
    errors = _identity_errors(projected, fits) if fits else {}
    facts = [(dim, i + 1, float(f["values"][i] / f["trace"]) if i < f["basis"].shape[1] else 0.0, errors[dim])
             for dim, f in fits.items() for i in range(f["width"])]
    known = table.sparkSession.createDataFrame(facts, "dim int, component int, explained double, identity_error double")
    rows = projected.select("vec_id", "dim", "n", "deviation", F.posexplode("w").alias("at", "whitened")) \
        .withColumn("component", F.col("at") + 1)
    # at most `components` rows a vector length
    return rows.join(F.broadcast(known), ["dim", "component"]) \
        .select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
