"""Toxicity by maximum-scoring segments of token log-odds, calibrated by extreme values.

*Evidence.* A token is a run of letters, read in lower case. For each word, and for its first 4 and 6
letters, the labelled documents that hold it are counted by label. The toxic share of a word is its
own count under a two-class Dirichlet prior whose mean is the share of its 6-letter beginning, which has
the share of the 4-letter beginning as its prior, which has that of all tokens. So common words stand
on their own counts, and unseen forms of a known stem lean on the stem. A token's score is the
log-odds of that share against the share of all tokens, less ``DRIFT``, so that neutral text falls.
The counts live in a count-min table of ``2 x 2^BITS`` cells a label: bounded whatever the
vocabulary, and the same size for any input.

*Search.* One linear scan (Ruzzo and Tompa 1999) finds all disjoint maximal-scoring segments.

*Calibration* (Karlin and Altschul 1990, 1993). Each labelled document is scored with its own counts
taken out. The scores of clean tokens give the decay lambda (the root of sum p(s) exp(lambda s) = 1),
the clean documents' best segments give K. A segment of score S in a document of n tokens has the
expected number E = K n exp(-lambda S) by chance; one with E up to ``PASSAGE_E`` is reported as a toxic
passage. The r best segments of a document together have the sum statistic's p-value; the smallest
over r, corrected for the choice of r, is the document's evidence (-ln p), and a logistic curve in
ln(1 + evidence), fitted on the same left-out documents, turns it into a probability.

Only the text reaches a score. The fit reads at most about ``TRAIN_ROWS`` labelled documents, drawn by
hash of the id; those whose crc32 of the decimal id leaves 1 modulo 3 are held out. All else covers
every document, whole.

Defined results. A null or empty text, or one without letters, has no token: it gets the score of no
evidence. A null id is scored and counts as held out. Rows that repeat an id are scored each by
itself; with several labels an id counts as toxic if one says so; null labels are no labels. Without
a labelled document of each kind every score is the toxic share of the labelled ones (0 if there are
none). Very long texts are scanned as a whole; the expected number grows with their length. Other columns
are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import small_batches, write_once

TOKEN = re.compile(r"[^\W\d_]+")
STEMS = (4, 6)              # letters of a word's beginnings
BITS = 19                   # 2 rows of 2^BITS cells a label
PRIOR = 20.0                # documents' worth of the prior mean
DRIFT = 1.0                 # nats a token
PASSAGE_E = 0.01
TRAIN_ROWS = 200_000
HELD_OUT = 1                # crc32 of the id modulo 3
TOXIC_FROM = 0.7
CACHE_WORDS = 400_000
EVIDENCE_STEP, EVIDENCE_TOP = 0.25, 200.0


# ---- evidence ---------------------------------------------------------------------------

def cells(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(levels x 2 x words cell numbers, levels x words presence): both stems, then the word itself."""
    mask, levels = (1 << BITS) - 1, len(STEMS) + 1
    at = np.zeros((levels, 2, len(words)), np.int64)
    present = np.ones((levels, len(words)), bool)
    for level in range(levels):
        stem = STEMS[level] if level < len(STEMS) else None
        keys = np.fromiter((xxhash.xxh64_intdigest(w[:stem], seed=level) for w in words), np.uint64, len(words))
        at[level, 0] = keys & np.uint64(mask)
        at[level, 1] = (1 << BITS) + ((keys >> np.uint64(32)) & np.uint64(mask)).astype(np.int64)
        if stem:
            present[level] = np.fromiter((len(w) > stem for w in words), bool, len(words))
    return at, present


def log_odds(words: list[str], table: np.ndarray, share: float, own: int | None = None) -> np.ndarray:
    """Score of each word; with ``own`` the label of a counted document that holds them is taken out once."""
    at, present = cells(words)
    r = np.full(len(words), share)
    for level in range(len(present)):
        clean, toxic = (table[y][at[level]].min(axis=0).astype(float) for y in (0, 1))
        if own is not None:
            clean, toxic = np.maximum(clean - (own == 0), 0), np.maximum(toxic - (own == 1), 0)
        r = np.where(present[level], (toxic + PRIOR * r) / (toxic + clean + PRIOR), r)
    return np.log(r / (1 - r)) - math.log(share / (1 - share)) - DRIFT


def count_cells(train: DataFrame) -> np.ndarray:
    """(label, cell) -> labelled documents that hold a word or stem of the cell, from ``train`` (text, toxic)."""

    def count(batches):
        table = np.zeros((2, 2 << BITS), np.int32)
        for batch in small_batches(batches, text=0):
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = list({w.lower() for w in TOKEN.findall(text or "")})
                at, present = cells(words)
                held = np.unique(at.transpose(0, 2, 1)[present])
                table[toxic][held] += 1
        used = np.flatnonzero(table.any(axis=0))
        for lo in range(0, len(used), 100_000):
            part = used[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(table[0][part].astype(np.int64)),
                                              pa.array(table[1][part].astype(np.int64))], ["cell", "clean", "toxic"])

    sums = (train.select("text", "toxic").mapInArrow(count, "cell long, clean long, toxic long")
            .groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    table = np.zeros((2, 2 << BITS), np.int32)
    got = sums.toArrow()                    # at most 2 x 2^BITS rows
    at = got.column("cell").to_numpy()
    table[0][at], table[1][at] = got.column("clean").to_numpy(), got.column("toxic").to_numpy()
    return table


# ---- search -----------------------------------------------------------------------------

def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(first token, token after the last, score) of all disjoint maximal-scoring segments, in linear time.

    Runs of positive scores enter as wholes. ``open_`` holds candidates with the cumulative sums
    before and after them; a new one joins back to the nearest candidate that begins lower, if that
    one ends lower than the new one.
    """
    up = np.flatnonzero(scores > 0)
    if not len(up):
        return []
    gap = np.flatnonzero(np.diff(up) > 1)
    first, last = up[np.r_[0, gap + 1]], up[np.r_[gap, len(up) - 1]] + 1
    total = np.concatenate([[0.0], np.cumsum(scores)])
    open_: list[tuple[int, int, float, float, int]] = []      # begin, end, sum before, sum after, nearest lower candidate
    for b, e, low, high in zip(first.tolist(), last.tolist(), total[first].tolist(), total[last].tolist()):
        while True:
            j = len(open_) - 1
            while j >= 0 and open_[j][2] >= low:
                j = open_[j][4]
            if j < 0 or open_[j][3] >= high:
                open_.append((b, e, low, high, j))
                break
            b, low = open_[j][0], open_[j][2]
            del open_[j:]
    return [(b, e, high - low) for b, e, low, high, _ in open_]


# ---- calibration ------------------------------------------------------------------------

def decay(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root lambda of sum p(s) exp(lambda s) = 1, where the mean is below 0; else 1."""
    p = counts / counts.sum()
    if not (values > 0).any() or (p * values).sum() >= 0:
        return 1.0
    f = lambda x: float((p * np.exp(np.minimum(x * values, 700))).sum()) - 1
    high = 1.0
    while f(high) < 0:
        high *= 2
    low = 0.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return high


def evidence(n: int, scores: Iterable[float], lam: float, k: float) -> float:
    """-ln of the smallest p-value of a document's r best segments together, over all r."""
    if n == 0:
        return 0.0
    base = math.log(k * n)
    y = sorted((lam * s - base for s in scores), reverse=True)
    if not y:
        return 0.0
    best = -math.log(-math.expm1(-math.exp(min(-y[0], 700)))) if y[0] < 30 else y[0]
    total = y[0]
    for r in range(2, len(y) + 1):
        total += y[r - 1]
        if y[r - 1] <= 0:
            break
        # sum statistic, and a factor 1/2 for each further segment allowed
        log_p = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r) + (r - 1) * math.log(2)
        best = max(best, -log_p)
    return max(best, 0.0)


def logistic(x: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> tuple[float, float]:
    """(a, b) of P(toxic) = 1 / (1 + exp(-a - b ln(1 + x))), a unit normal prior on b; b is not negative."""
    x = np.log1p(x)
    a, b = 0.0, 0.0
    n = toxic + clean
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -500, 500)))
        w = n * p * (1 - p)
        ga, gb = (toxic - n * p).sum() - 1e-3 * a, ((toxic - n * p) * x).sum() - b
        haa, hab, hbb = w.sum() + 1e-3, (w * x).sum(), (w * x * x).sum() + 1
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 5 / max(abs(da), abs(db), 1e-300))
        a, b = a + step * da, b + step * db
        if max(abs(da), abs(db)) < 1e-10:
            break
    return (a, b) if b > 0 else (math.log((toxic.sum() + 0.5) / (clean.sum() + 0.5)), 0.0)


def _left_out(train: DataFrame, table, share: float) -> DataFrame:
    """(toxic, n, segments, score, times) of each labelled document, its own counts taken out.

    ``score`` and ``times`` are the histogram of its token scores in steps of 1/64.
    """

    def scan(batches):
        for batch in small_batches(batches, text=0):
            rows = ([], [], [], [], [])
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = [w.lower() for w in TOKEN.findall(text or "")]
                words = {w: i for i, w in enumerate(dict.fromkeys(tokens))}
                s = log_odds(list(words), table.value, share, own=toxic)[[words[w] for w in tokens]] if tokens else np.empty(0)
                v, c = np.unique(np.floor(s * 64 + 0.5).astype(np.int64), return_counts=True)
                for col, x in zip(rows, (toxic, len(tokens), [g[2] for g in maximal_segments(s)], v, c)):
                    col.append(x)
            types = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types)],
                                             ["toxic", "n", "segments", "score", "times"])

    return train.select("text", "toxic").mapInArrow(
        scan, "toxic int, n long, segments array<double>, score array<long>, times array<long>")


def _evidences(left_out: DataFrame, lam: float, k: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Histogram of the left-out evidence: (its values, toxic, clean)."""

    def weigh(batches):
        for batch in batches:
            x = [evidence(n, s, lam, k) for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            step = np.round(np.minimum(x, EVIDENCE_TOP) / EVIDENCE_STEP).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(0)], ["step", "toxic"])

    counts = (left_out.select("toxic", "n", "segments").mapInArrow(weigh, "step long, toxic int")
              .groupBy("step").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).collect())
    step, t, n = (np.asarray([float(r[c]) for r in counts]) for c in ("step", "t", "n"))
    return step * EVIDENCE_STEP, t, n - t


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> dict:
    """The model of ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic): table, share, lambda, K, a, b."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = write_once(known, "toxicity-labels")
    draw = F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 62) - 1)) < int(min(1.0, rows / max(1, known.count())) * (1 << 62))
    drawn = F.broadcast(known.filter(draw))          # about ``rows`` rows of two numbers
    train = write_once(docs.filter("doc_id is not null").join(drawn, "doc_id").select("text", "toxic"), "toxicity-train")
    n, toxic = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if toxic in (0, n):
        return {"table": None, "prior": toxic / n if n else 0.0}
    table = count_cells(train)
    share = float(table[1].sum() / table.sum()) if table[1].any() else toxic / n
    share = min(max(share, 1e-6), 1 - 1e-6)
    shared = train.sparkSession.sparkContext.broadcast(table)       # 2 x 2 x 2^BITS numbers
    seen = write_once(_left_out(train, shared, share), "toxicity-left-out")
    clean = seen.filter("toxic = 0")
    # scores lie within the log of the counts; one more clean token is added at the top score of all
    hist = seen.select("toxic", F.explode(F.arrays_zip("score", "times")).alias("z")).groupBy("z.score") \
        .agg(F.sum(F.when(F.col("toxic") == 0, F.col("z.times")).otherwise(0)).alias("times")).orderBy("score").collect()
    times = np.asarray([float(r["times"]) for r in hist])
    times[-1:] += 1
    lam = decay(np.asarray([r["score"] / 64 for r in hist]), times) if hist else 1.0
    best = F.coalesce(F.array_max("segments"), F.lit(0.0))
    worded, chance = clean.filter("n > 0").agg(F.count(F.lit(1)), F.sum(F.col("n") * F.exp(-lam * best))).first()
    k = worded / chance if worded else 1.0
    a, b = logistic(*_evidences(seen, lam, k))
    return {"table": table, "shared": shared, "share": share, "lambda": lam, "k": k, "a": a, "b": b}


# ---- scoring ----------------------------------------------------------------------------

def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == HELD_OUT, F.lit(True))


class _Scorer:
    """Scores texts in a worker; words seen before are looked up."""

    def __init__(self, table: np.ndarray, model: dict):
        self.table, self.m, self.known = table, model, {}

    def learn(self, texts: list[list[str]]) -> None:
        new = {w for tokens in texts for w in tokens}
        if len(self.known) + len(new) > CACHE_WORDS:
            self.known = {}
        new = [w for w in new if w not in self.known]
        if new:
            self.known.update(zip(new, log_odds([w.lower() for w in new], self.table, self.m["share"]).tolist()))

    def judge(self, text: str, tokens: list[str]) -> tuple[float, list[dict]]:
        m, n = self.m, len(tokens)
        found = maximal_segments(np.fromiter(map(self.known.__getitem__, tokens), float, n))
        x = min(evidence(n, [s for *_, s in found], m["lambda"], m["k"]), EVIDENCE_TOP)
        score = 1 / (1 + math.exp(-max(-500.0, min(500.0, m["a"] + m["b"] * math.log1p(x)))))
        passages = [(b, e, s, m["k"] * n * math.exp(-m["lambda"] * s)) for b, e, s in found]
        passages = [p for p in passages if p[3] <= PASSAGE_E]
        if passages:
            at = [t.span() for t in TOKEN.finditer(text)]
            passages = [{"start": at[b][0], "end": at[e - 1][1], "score": s, "expected": x} for b, e, s, x in passages]
        return score, passages


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages) of every row.

    ``passages``: code points (start, end), score and expected number by chance of each significant segment.
    """
    whole = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    model = fit_toxicity(whole, labels, rows)
    spans = "array<struct<start:long,end:long,score:double,expected:double>>"
    if model["table"] is None:
        out = whole.select("doc_id", F.lit(model["prior"]).alias("score"), F.lit(None).cast(spans).alias("passages"))
    else:
        numbers, shared = {k: model[k] for k in ("share", "lambda", "k", "a", "b")}, model["shared"]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))

        def score(batches):
            scorer = _Scorer(shared.value, numbers)
            for batch in small_batches(batches):
                texts = [t or "" for t in batch.column(1).to_pylist()]
                tokens = [TOKEN.findall(t) for t in texts]
                scorer.learn(tokens)
                judged = [scorer.judge(t, w) for t, w in zip(texts, tokens)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([j[0] for j in judged], pa.float64()),
                                                  pa.array([j[1] for j in judged], kind)], ["doc_id", "score", "passages"])

        out = whole.mapInArrow(score, f"doc_id long, score double, passages {spans}")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "passages")
