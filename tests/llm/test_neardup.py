import random
from collections import Counter

import numpy as np
import pytest
from helpers import DOCS, ascii_lower, awkward_docs, words

from playstats.llm import neardup
from playstats.llm.neardup import least_matches, near_duplicates
from playstats.llm.shingles import shingle_set


def shingles(text, width):
    w = words(ascii_lower(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width, percent):
    """(doc, n, component, kept) of each row, classes named after the smallest id of their set."""
    sets = [shingles(r[1], width) for r in rows]
    first = {}
    for r, s in zip(rows, sets):
        if s and r[0] is not None:
            first[s] = min(first.get(s, r[0]), r[0])
    kinds = list(first)
    parent = {first[s]: first[s] for s in kinds}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                x, y = sorted((root(first[a]), root(first[b])))
                parent[y] = x
    out = []
    for r, s in zip(rows, sets):
        comp = root(first[s]) if s in first else r[0]
        out.append((r[0], len(s), comp, comp is not None and comp == r[0]))
    return out


def same(spark, rows, width, percent):
    got = near_duplicates(spark.createDataFrame(rows, DOCS), width=width, percent=percent).collect()
    want = brute(rows, width, percent)
    assert Counter(map(tuple, got)) == Counter(want)
    return want


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_awkward_rows(spark, width, percent):
    want = same(spark, awkward_docs(), width, percent)
    comps = Counter(c for _, _, c, _ in want)
    assert comps[0] >= 6 and comps[200] >= 8


def edited(rnd, base, n):
    out = list(base)
    for i in rnd.sample(range(len(base)), n):
        out[i] = f"e{rnd.randint(0, 10 ** 9)}"
    return " ".join(out)


def test_groups_with_links_around_the_threshold(spark):
    """Near copies whose pairs lie on both sides of the threshold, chains, and bystanders."""
    rnd = random.Random(11)
    rows, n = [], 0
    for g in range(12):
        base = [f"g{g}w{rnd.randint(0, 500)}" for _ in range(rnd.choice([40, 120, 300]))]
        for _ in range(25):
            rows.append((n, edited(rnd, base, rnd.randint(0, max(1, len(base) // 12))), "en", "s", 0))
            n += 1
    chain = [f"c{i}" for i in range(200)]
    for i in range(30):
        rows.append((n, " ".join(chain), "en", "s", 0))
        n += 1
        chain = chain[4:] + [f"d{i}x{j}" for j in range(4)]
    for _ in range(100):
        rows.append((n, " ".join(f"z{rnd.randint(0, 3000)}" for _ in range(60)), "en", "s", 0))
        n += 1
    rnd.shuffle(rows)
    want = same(spark, rows, 3, 85)
    sizes = Counter(Counter(c for _, _, c, _ in want).values())
    assert len(sizes) > 3


def test_exhaustive_comparison_alone_finds_every_link(spark, monkeypatch):
    """With useless hubs all links come from the comparison between components."""
    empty = lambda pairs, *a: pairs.filter("false")
    real, calls = neardup._promising, []

    def first_empty(*a):
        calls.append(1)
        return empty(a[0]) if len(calls) == 1 else real(*a)

    monkeypatch.setattr(neardup, "_promising", first_empty)
    monkeypatch.setattr(neardup, "STRAYS", 3)
    monkeypatch.setattr(neardup, "BODY", 4)
    same(spark, awkward_docs(), 3, 85)


def test_small_sets(spark):
    rows = [(1, "a", "", "", 0), (2, "A", "", "", 0), (3, "a b", "", "", 0), (4, " a\tb\n", "", "", 0), (5, "b a", "", "", 0),
            (6, "a b c", "", "", 0), (7, "", "", "", 0), (8, None, "", "", 0), (None, "q r s t", "", "", 0), (9, "é É", "", "", 0)]
    same(spark, rows, 3, 85)


def test_empty_table_and_clashing_columns(spark):
    assert near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, "a b", "x", 2), (2, "a b", "x", 2)], "doc_id long, text string, node string, comp int")
    assert {r["component_id"] for r in near_duplicates(df).collect()} == {1}


def test_least_matches_is_the_posterior_bound():
    rnd = np.random.default_rng(0)
    for n, t in ((32, 0.8), (64, 0.85), (128, 0.8)):
        m = least_matches(n, t, 1e-3)
        draws = lambda k: (rnd.beta(k + 1, n - k + 1, 400_000) >= t).mean()
        assert draws(m) >= 0.5e-3 and draws(m - 1) <= 2e-3


def test_shingle_hashes_follow_the_words():
    assert len(shingle_set("The the THE the", 3)) == 1
    assert np.array_equal(shingle_set("a  b\x0bc d", 3), shingle_set("A b C D", 3))
    assert not np.array_equal(shingle_set("a b", 3), shingle_set("b a", 3))
    assert len(shingle_set("é É", 3)) == 1 and not np.array_equal(shingle_set("é", 3), shingle_set("É", 3))
