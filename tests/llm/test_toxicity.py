import math
import random
import zlib

import numpy as np
import pytest
from helpers import DOCS, awkward_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from playstats.llm import toxicity as T
from playstats.llm.toxicity import decay, evidence, log_odds, logistic, maximal_segments, score_toxicity

LABELS = "doc_id long, toxic int, score double"


def by_recursion(scores, lo=0):
    """All maximal segments: the best one (the shortest, then the first), and those to its left and right."""
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            key = (total, -(j - i))
            if total > 0 and (best is None or key > best[0]):
                best = (key, i, j + 1, total)
    if best is None:
        return []
    _, i, j, total = best
    return by_recursion(scores[:i], lo) + [(lo + i, lo + j, total)] + by_recursion(scores[j:], lo + j)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3, -2, -1, 1, 2, 5]), max_size=25), st.randoms())
def test_scan_finds_all_maximal_segments(scores, rnd):
    scores = [s + rnd.random() * 1e-3 for s in scores]      # no ties
    got = maximal_segments(np.asarray(scores, float))
    want = by_recursion(scores)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-9 for g, w in zip(got, want))


def test_decay_is_the_root():
    v, p = np.asarray([-1.0, 0.5, 2.0]), np.asarray([80.0, 15.0, 5.0])
    lam = decay(v, p)
    assert lam > 0 and abs(float((p / p.sum() * np.exp(lam * v)).sum()) - 1) < 1e-9
    assert decay(np.asarray([-1.0]), np.asarray([3.0])) == 1.0      # no positive score at all


def test_evidence_against_the_formulas():
    lam, k, n = 1.3, 0.05, 400
    y = [lam * s - math.log(k * n) for s in (7.0, 5.0, 4.0)]
    one = -math.log(1 - math.exp(-math.exp(-y[0])))
    two = sum(y[:2]) - math.log(sum(y[:2])) + math.lgamma(3) + math.lgamma(2) - math.log(2)
    three = sum(y) - 2 * math.log(sum(y)) + math.lgamma(4) + math.lgamma(3) - 2 * math.log(2)
    assert abs(evidence(n, [5.0, 4.0, 7.0], lam, k) - max(one, two, three)) < 1e-9
    assert evidence(n, [], lam, k) == 0 and evidence(0, [], lam, k) == 0
    assert evidence(10 * n, [7.0], lam, k) < evidence(n, [7.0], lam, k)      # longer texts expect more by chance


def test_log_odds_of_exact_counts():
    table = np.zeros((2, 2 << T.BITS), np.int32)
    at, _ = T.cells(["poison", "poisonous"])
    for label, level, word, n in ((1, 2, 0, 30), (0, 2, 0, 2), (1, 0, 0, 40), (0, 0, 0, 10), (0, 1, 1, 0), (1, 1, 1, 35)):
        table[label][at[level, :, word]] += n
    share, a = 0.1, T.PRIOR
    stem = (40 + a * share) / (50 + a)
    r = (30 + a * stem) / (32 + a)                       # six letters: stem of four, then the word
    want = math.log(r / (1 - r)) - math.log(share / (1 - share)) - T.DRIFT
    longer = (35 + a * stem) / (35 + a)                  # an unseen form leans on both of its stems
    unseen = math.log(longer / (1 - longer)) - math.log(share / (1 - share)) - T.DRIFT
    got = log_odds(["poison", "poisonous", "other"], table, share)
    assert np.allclose(got, [want, unseen, -T.DRIFT])
    r = (29 + a * (39 + a * share) / (49 + a)) / (31 + a)
    assert np.allclose(log_odds(["poison"], table, share, own=1), math.log(r / (1 - r)) - math.log(share / (1 - share)) - T.DRIFT)


def test_logistic_separates():
    x = np.asarray([0.0, 1.0, 2.0, 30.0, 60.0])
    a, b = logistic(x, np.asarray([1.0, 1.0, 0.0, 50.0, 50.0]), np.asarray([500.0, 300.0, 50.0, 0.0, 0.0]))
    p = 1 / (1 + np.exp(-a - b * np.log1p(x)))
    assert b > 0 and p[0] < 0.05 and p[-1] > 0.95


def corpus(n=400, seed=2):
    rnd = random.Random(seed)
    calm = [f"calm{i}" for i in range(400)] + ["the", "and", "of"] * 30
    bad = ["vile", "rotten", "filthcraft", "filthmonger", "filthling"]
    rows, labels = [], []
    for i in range(n):
        text = [rnd.choice(calm) for _ in range(rnd.randint(20, 150))]
        toxic = i % 8 == 0
        if toxic:
            at = rnd.randint(0, len(text))
            text[at:at] = [rnd.choice(bad) for _ in range(6)]
        rows.append((i, " ".join(text) + ".", "en", "a", 1))
        labels.append((i, int(toxic), 0.0))
    return rows, labels


def test_passages_are_found_and_clean_texts_left_alone(spark):
    rows, labels = corpus()
    clean = " ".join(r[1] for r in rows if r[0] % 8)
    planted = clean[:9000] + " Vile ROTTEN filthcraft, filthmonger rotten vile! " + clean[9000:40000]
    rows += [(1000, planted, "en", "a", 1), (1001, clean, "en", "a", 1), (1002, "filthdom vile filthster rotten", "en", "a", 1)]
    out = {r["doc_id"]: r for r in score_toxicity(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(out[i]["predicted"] == t for i, t, _ in labels)
    assert out[1000]["predicted"] == 1 and out[1001]["predicted"] == 0 and out[1002]["predicted"] == 1
    (p,) = out[1000]["passages"]
    assert planted[p["start"]:p["end"]] == "Vile ROTTEN filthcraft, filthmonger rotten vile" and p["expected"] <= T.PASSAGE_E
    assert all(out[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in out)


def test_held_out_labels_teach_nothing(spark):
    rows, labels = corpus()
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t, s) for i, t, s in labels]
    docs = spark.createDataFrame(rows, DOCS)
    a, b = (sorted(map(tuple, score_toxicity(docs, spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect()))
            for x in (labels, turned))
    assert a == b


def test_defined_results(spark):
    rows, labels = corpus(160)
    odd = [(None, "vile rotten vile rotten vile rotten", None, None, None), (501, None, None, None, None), (502, "", "en", "a", 0),
           (503, "123 _ !", "en", "a", 0), (0, rows[0][1], "en", "a", 1)]
    labels += [(None, 1, 0.0), (501, None, 0.0), (0, None, 0.0), (8, 0, 0.0), (9999, 1, 0.0)]
    docs = spark.createDataFrame(rows + odd, DOCS)
    out = score_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r["score"] <= 1 for r in out)
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[None][0]["held_out"] and by[None][0]["predicted"] == 1
    assert len({by[i][0]["score"] for i in (501, 502, 503)}) == 1 and by[501][0]["predicted"] == 0
    assert len(by[0]) == 2 and by[0][0]["score"] == by[0][1]["score"]
    none = score_toxicity(docs, spark.createDataFrame([], LABELS)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    one = score_toxicity(docs, spark.createDataFrame([(i, 1, 0.0) for i in range(20)], LABELS)).collect()
    assert {(r["score"], r["predicted"]) for r in one} == {(1.0, 1)}
    assert score_toxicity(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    assert score_toxicity(spark.createDataFrame(awkward_docs(), DOCS), spark.createDataFrame(labels, LABELS)).count() == len(awkward_docs())


@pytest.mark.parametrize("sf,least", [("sf0.1", 0.88)])
def test_held_out_accuracy(spark, sf, least):
    from playstats.llm.queries import op13_toxicity
    root = f"/root/testdata/{sf}"
    out = op13_toxicity(spark, root).join(spark.read.parquet(f"{root}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    held = out.filter("held_out").collect()
    toxic, clean = [r for r in held if r["toxic"] == 1], [r for r in held if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= least * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.005 * len(clean)
