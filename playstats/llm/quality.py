"""Quality classifier from weak labels: labellers, expectation-maximisation, hashed linear scorer.

Heuristic labellers vote good (1), poor (0) or abstain (2) on each whole text. The vote patterns of
all documents are counted (at most 3^9 rows), and expectation-maximisation on these counts
estimates the share of good documents and each labeller's vote rates in either class, with no
true label. The posteriors label a bounded sample (``SAMPLE`` documents, drawn by hash of the id)
on which a logistic scorer over hashed byte trigrams and the votes is fitted; it scores every
document. A document is kept if its score reaches ``KEEP``.

Defined results. A null or empty text, or one without words, gets no vote, the prior as weak label,
score 0 and is not kept. Repeated rows are judged alike. An empty table gives an empty result.
If the sample's labels are all alike, the weak label itself is the score.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import small_batches, write_once

SAMPLE = 6_000
BINS = 512
KEEP = 0.5
# classes of UTF-8 bytes: 0 other, 1 small letter, 2 capital, 3 first byte of a character beyond
# ASCII, 4 symbol, 5 later byte
_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[192:], _CLASS[128:192] = 1, 2, 3, 5
_CLASS[[ord(c) for c in "#$%&*@^~|\\<>{}=_+[]"]] = 4
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")


def _between(x: float, good: float, poor: float) -> int:
    """1 up to ``good``, 0 from ``poor``, 2 (abstain) between (or the other way round)."""
    if good < poor:
        return 1 if x <= good else 0 if x >= poor else 2
    return 1 if x >= good else 0 if x <= poor else 2


def votes(text: str | None) -> tuple[int, ...]:
    """The labellers' votes on a whole text."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return (2,) * len(LABELLERS)
    raw = text.encode("utf-8", "surrogatepass")
    _, small, capital, beyond, symbol, later = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=6).tolist()
    letters = small + capital + beyond
    follow = words[1:]
    top = max(Counter(words).values())
    return (
        _between((symbol + text.count("!!")) / n, 0.05, 0.2),
        _between(capital / max(1, letters), 0.15, 0.4),
        _between(len(_BARE.findall(text)) / n, 0.05, 0.2),
        _between(letters / (len(raw) - later), 0.7, 0.6),
        2 if n < 15 else _between(sum(map((4).__gt__, map(len, words))) / n, 0.15, 0.05),
        _between(top / max(20, n), 0.15, 0.35),
        2 if n < 10 else _between(sum(map(eq, words, follow)) / n, 0.02, 0.1),
        2 if n < 10 else _between(len(set(zip(words, follow))) / (n - 1), 0.8, 0.6),
        2 if n < 30 else _between(len(zlib.compress(raw, 1)) / len(raw), 0.37, 0.35),
    )


LABELLERS = ("symbols", "capitals", "bare separators", "letter share", "short words", "one word's share", "stutter", "pair variety",
             "compressibility")


def fit_label_model(patterns: dict[tuple[int, ...], int], rounds: int = 200) -> tuple[float, np.ndarray]:
    """(share of good documents, P(vote | labeller, class) as labellers x 2 x 2) by EM on vote counts.

    An abstention says nothing about the class.
    """
    v = np.asarray(list(patterns), dtype=np.int64).reshape(len(patterns), -1)
    n = np.asarray(list(patterns.values()), dtype=float)
    yes, no = (v == 1).sum(axis=1), (v == 0).sum(axis=1)
    post = (yes + 1.0) / (yes + 3.0 * no + 2.0)          # start: good unless labellers object
    for _ in range(rounds):
        share = float((n * post).sum() / n.sum())
        rates = np.empty((v.shape[1], 2, 2))
        for j in range(v.shape[1]):
            for c, w in enumerate((n * (1 - post), n * post)):
                rates[j, c] = [w[v[:, j] == x].sum() + 0.5 for x in range(2)]
        rates /= rates.sum(axis=2, keepdims=True)
        new = posterior(v, share, rates)
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return share, rates


def posterior(v: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """P(good | votes) of each row of votes."""
    heard = np.concatenate([np.log(rates), np.zeros((*rates.shape[:2], 1))], axis=2)     # 2: abstained
    logs = np.log(np.clip([1 - share, share], 1e-9, 1))[None, :] + sum(
        heard[j][:, v[:, j]].T for j in range(v.shape[1]))
    return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def features(text: str | None, voted: tuple[int, ...]) -> np.ndarray:
    """Hashed trigram frequencies (square roots, unit length), then the good and poor votes."""
    own = np.asarray([[v == 1, v == 0] for v in voted], dtype=np.float32).ravel()
    return np.concatenate([_trigrams(text), own])


def _trigrams(text: str | None) -> np.ndarray:
    b = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(BINS, np.float32)
    key = b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]
    bins = (key * np.uint32(2654435761)) >> np.uint32(32 - BINS.bit_length() + 1)
    x = np.sqrt(np.bincount(bins, minlength=BINS))
    return (x / np.sqrt((x ** 2).sum())).astype(np.float32)


def _voted(rows: DataFrame) -> DataFrame:
    def label(batches):
        for batch in small_batches(batches):
            codes = ["".join(map(str, votes(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.string())], ["doc_id", "votes"])
    return rows.mapInArrow(label, "doc_id long, votes string")


def _featured(rows: DataFrame) -> DataFrame:
    def make(batches):
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            v = [votes(t) for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(["".join(map(str, x)) for x in v], pa.string()), pa.array(
                [features(t, x) for t, x in zip(texts, v)], pa.list_(pa.float32()))], ["votes", "x"])

    return rows.mapInArrow(make, "votes string, x array<float>")


def _scorer(rows: DataFrame, weak: dict[str, float], sample: int, n: int) -> tuple[np.ndarray, float] | None:
    """Weights and intercept fitted on the posteriors of a bounded sample; None if these are alike."""
    at = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1))
    drawn = rows.filter((F.length("text") > 0) & (at <= int(min(1.0, sample / max(1, n)) * (1 << 62))))
    label = F.create_map(*[F.lit(x) for kv in weak.items() for x in kv])
    data = write_once(_featured(drawn).select("x", label[F.col("votes")].alias("p")), "quality-sample")
    low, high = data.agg(F.min("p"), F.max("p")).first()
    if low is None or high - low < 0.5:
        return None
    both = data.select(array_to_vector(F.col("x").cast("array<double>")).alias("features"), F.explode(F.array(
        F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight")))).alias("y")) \
        .select("features", "y.*").filter("weight > 1e-6")
    model = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=60).fit(both)
    return np.asarray(model.coefficients.toArray()), float(model.intercept)


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE,
                  keep: float = KEEP) -> DataFrame:
    """(doc_id, votes, weak_label, score, keep) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    tally = {r["votes"]: r["n"] for r in _voted(rows).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(tally.values())
    blank = "2" * len(LABELLERS)
    seen = {tuple(map(int, k)): c for k, c in tally.items() if k != blank}
    if seen:
        share, rates = fit_label_model(seen)
        weak = dict(zip(tally, posterior(np.asarray([list(map(int, k)) for k in tally]), share, rates).tolist()))
    else:
        share, weak = 0.5, dict.fromkeys(tally, 0.5)
    model = _scorer(rows, weak, sample, n) if seen else None

    def score(batches):
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            voted = [votes(t) for t in texts]
            codes = ["".join(map(str, v)) for v in voted]
            p = [weak.get(c, share) for c in codes]
            if model:
                raw = np.stack([features(t, v) for t, v in zip(texts, voted)]) @ model[0] + model[1]
                s = 1 / (1 + np.exp(-np.clip(raw, -700, 700)))
            else:
                s = np.asarray(p)
            worded = np.asarray([bool((t or "").strip()) for t in texts])
            s = np.where(worded, s, 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes), pa.array(p, pa.float64()), pa.array(s, pa.float64()),
                 pa.array(worded & (s >= keep))], ["doc_id", "votes", "weak_label", "score", "keep"])

    return rows.mapInArrow(score, "doc_id long, votes string, weak_label double, score double, keep boolean")
