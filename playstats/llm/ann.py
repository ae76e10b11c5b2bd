"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

*Fit.* On at most ``SAMPLE`` vectors (drawn by hash of the id) the principal axes and several
rotations are learned so that the signs of the rotated coordinates lose least (iterative
quantization); each rotation gives up to 64 bits of code. The Hamming radius is learned on the
same sample: the distance that ``RECALL`` of the true neighbours of sampled queries stay within.
A larger table has nearer neighbours, so the radius errs on the wide side.

*Index.* Every row gets a code. The code is cut into substrings of 8 bits, each with its own
inverted table. *Search.* A code within radius r of the query's has a substring within
floor(r / substrings) bits (pigeonhole), so probing each table at that distance finds all codes
within r; they are checked on the whole code and reranked by exact double inner products.
Where a block holds fewer than k codes within the radius, its radius is widened, so a query
never returns fewer than k neighbours while there are as many candidates.

Largest inner products become nearest angles by one extra coordinate, sqrt(M^2 - |x|^2) for
candidates (M the largest norm) and 0 for queries.

Defined results. Null, empty and zero vectors, and those with null or non-finite components, take
no part, as do rows without id; rows that repeat an id count once (smallest vector). Vectors
meet those of their own length; lengths without fitted codes are searched exactly. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import write_once
from playstats.llm.vectors import finite_vectors, search_blocks

SAMPLE = 20_000
ROTATIONS = 4
RECALL = 0.98
STEPS = 15


def _widen(x: np.ndarray, largest: float) -> np.ndarray:
    extra = np.sqrt(np.maximum(largest ** 2 - (x ** 2).sum(axis=1), 0))
    return np.column_stack([x, extra])


def _signs(x: np.ndarray, model: dict) -> np.ndarray:
    """Codes (rows x bytes) of widened vectors."""
    bits = (x - model["mean"]) @ model["axes"] >= 0
    return np.packbits(bits, axis=1)


def _distance(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def fit_codes(sample: np.ndarray, largest: float, k: int, seed: int = 1) -> dict:
    """Rotated sign codes and a Hamming radius, learned on ``sample`` (rows x dimensions)."""
    rng = np.random.default_rng(seed)
    x = _widen(sample, largest)
    mean = x.mean(axis=0)
    centred = x - mean
    _, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, ::-1][:, :min(64, sample.shape[1])]
    flat = centred @ axes
    parts = []
    for _ in range(ROTATIONS):
        turn, _ = np.linalg.qr(rng.standard_normal((axes.shape[1],) * 2))
        for _ in range(STEPS):
            u, _, vt = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
            turn = (u @ vt).T
        parts.append(axes @ turn)
    model = {"mean": mean, "axes": np.concatenate(parts, axis=1), "largest": largest}
    codes = _signs(x, model)
    bits = 8 * codes.shape[1]
    far = []
    for i in rng.permutation(len(sample))[:400]:
        scores = sample @ sample[i]
        scores[i] = -np.inf
        top = np.argsort(-scores)[:min(k, len(sample) - 1)]
        query = _signs(np.append(sample[i], 0.0)[None, :], model)[0]
        far.append(_distance(codes[top], query))
    model["radius"] = int(np.quantile(np.concatenate(far), RECALL)) if far and len(far[0]) else bits
    return model


class _SubstringTables:
    """Inverted tables of a block's code bytes; rows are bits of packed masks."""

    def __init__(self, codes: np.ndarray):
        n, self.subs = codes.shape
        self.n = n
        self.exact = np.zeros((self.subs, 256, (n + 7) // 8), np.uint8)
        bit = np.left_shift(1, 7 - np.arange(n) % 8).astype(np.uint8)
        for j in range(self.subs):
            np.bitwise_or.at(self.exact[j], (codes[:, j], np.arange(n) // 8), bit)
        values = np.arange(256, dtype=np.uint8)
        self.apart = np.bitwise_count(values[:, None] ^ values[None, :])
        self.balls: dict[tuple[int, int, int], np.ndarray] = {}

    def probe(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows with a substring within floor(radius / substrings) bits of the query's."""
        t = radius // self.subs
        mask = np.zeros(self.exact.shape[2], np.uint8)
        for j, v in enumerate(code.tolist()):
            ball = self.balls.get((j, v, t))
            if ball is None:
                ball = np.bitwise_or.reduce(self.exact[j][self.apart[v] <= t], axis=0)
                self.balls[j, v, t] = ball
            mask |= ball
        return np.nonzero(np.unpackbits(mask, count=self.n))[0]


def _kernel(models: dict[int, dict], k: int):
    def search(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        ids, x = cs["vec_id"].to_numpy(), np.stack(cs["vec"])
        model = models.get(x.shape[1])
        if model:
            codes = np.frombuffer(b"".join(cs["code"]), np.uint8).reshape(len(cs), -1)
            tables = _SubstringTables(codes)
        out = []
        for qid, q in zip(qs["vec_id"], qs["vec"]):
            own = ids == qid
            if model:
                code = _signs(np.append(q, 0.0)[None, :], model)[0]
                radius = model["radius"]
                while True:
                    rows = tables.probe(code, radius)
                    rows = rows[(_distance(codes[rows], code) <= radius) & ~own[rows]]
                    if len(rows) >= min(k, len(ids) - own.sum()):
                        break
                    radius += tables.subs
            else:
                rows = np.nonzero(~own)[0]
            score = (x[rows] * q).sum(axis=1)
            top = np.lexsort((ids[rows], -score))[:k]
            out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows][top], "score": score[top]}))
        return pd.concat(out, ignore_index=True)

    return search


def _coded(vectors: DataFrame, models: dict[int, dict]) -> DataFrame:
    def code(frames):
        for pdf in frames:
            out: list[bytes | None] = [None] * len(pdf)
            for dim, model in models.items():
                rows = np.nonzero(pdf["dim"].to_numpy() == dim)[0]
                if len(rows):
                    signs = _signs(_widen(np.stack(pdf["vec"].iloc[rows]), model["largest"]), model)
                    for i, s in zip(rows, signs):
                        out[i] = s.tobytes()
            pdf["code"] = out
            yield pdf

    return vectors.mapInPandas(code, "vec_id long, dim int, vec array<double>, code binary")


def _fit_on_executor(drawn: DataFrame, largest: float, k: int) -> dict | None:
    """:func:`fit_codes` in one task over the bounded sample ``drawn`` (vec).

    The fit needs matrix products and decompositions. A worker has one BLAS thread of its own; in the
    driver process the library's threads may have been lost in the fork that started the JVM.
    """

    def fit(frames):
        rows = [v for pdf in frames for v in pdf["vec"]]
        if len(rows) > 1:
            m = fit_codes(np.stack(rows).astype(np.float64), largest, k)
            yield pd.DataFrame({"mean": [m["mean"]], "axes": [m["axes"].ravel()], "radius": [m["radius"]]})

    made = drawn.coalesce(1).mapInPandas(fit, "mean array<double>, axes array<double>, radius int").collect()
    if not made:
        return None
    mean = np.asarray(made[0]["mean"])
    return {"mean": mean, "axes": np.asarray(made[0]["axes"]).reshape(len(mean), -1), "largest": largest,
            "radius": made[0]["radius"]}


def nearest_neighbours(table: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
                       vector_col: str = "embedding", sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for ids divisible by ``every``."""
    vectors = write_once(finite_vectors(table, id_col, vector_col)
                         .filter(F.exists("vec", lambda x: x != 0))
                         .select("vec_id", F.size("vec").alias("dim"), "vec"), "ann-vectors")
    dims = {r["dim"]: (r["n"], r["m"]) for r in vectors.groupBy("dim").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("m"))
        .orderBy(F.desc("n")).limit(4).collect()}        # codes are fitted for the 4 commonest lengths
    n = vectors.count()
    models = {}
    for dim, (rows, largest) in dims.items():
        at = F.xxhash64("vec_id").bitwiseAND(F.lit((1 << 62) - 1))
        drawn = (vectors.filter((F.col("dim") == dim) & (at <= int(min(1.0, 1.1 * sample / rows) * (1 << 62))))
                 .select("vec").limit(sample))
        model = _fit_on_executor(drawn, largest, k)
        if model:
            models[dim] = model
    ready = write_once(_coded(vectors, models), "ann-codes")
    queries = ready.filter(F.pmod("vec_id", F.lit(every)) == 0)
    return search_blocks(queries, ready, _kernel(models, k), k, "double", queries.count(), n)
