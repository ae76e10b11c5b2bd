from collections import Counter, defaultdict

import pytest
from helpers import DOCS, awkward_docs, words

from playstats.llm.mixing import mix_sources, take


def targets(sizes, weights=(5, 2, 1), most=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        level = rest / sum(w[s] for s in free) if free else 0
        more = {s for s in free if w[s] * level > most * sizes[s]}
        if not more:
            return {s: most * sizes[s] if s in capped else w[s] * level for s in order}
        capped |= more


def check(spark, rows):
    out = mix_sources(spark.createDataFrame(rows, DOCS)).collect()
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    want = targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((d, len(words(t))) for d, t, *_ in rows)
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["copies"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    return want, taken, largest, out


def test_targets_of_awkward_rows(spark):
    check(spark, awkward_docs())


def test_taken_words_come_near_the_targets(spark):
    rows = [(i, "w " * (1 + i * 13 % 97), "en", "hot" if i % 3 == 0 else f"s{i % 7}", 0) for i in range(3000)]
    want, taken, largest, _ = check(spark, rows)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_rows_without_an_id_are_taken_apart(spark):
    rows = [(None, f"text{i} " * (1 + i % 5), "en", "a", 0) for i in range(400)]
    rows += [(7, f"other{i} " * 3, "en", "b", 0) for i in range(400)] + [(i, "w w w", "en", "c", 0) for i in range(400)]
    want, taken, largest, _ = check(spark, rows)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in want)


def test_excess_is_shared_again(spark):
    rows = [(0, "a b", "en", "a", 0), (1, "c " * 500, "en", "b", 0), (2, "d " * 40, "en", "c", 0)]
    want, *_ = check(spark, rows)
    assert want["a"] == 6 and want["c"] == 120 and want["b"] == 542 - 126


def test_reruns_agree_and_mix_repeats_documents(spark):
    rows = awkward_docs()
    df = spark.createDataFrame(rows, DOCS)
    a, b = mix_sources(df), mix_sources(df.repartition(5))
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))
    mixed = take(a, df.columns)
    assert mixed.columns == df.columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    assert times == Counter({k: v for k, v in sum((Counter({r["doc_id"]: r["copies"]}) for r in a.collect()), Counter()).items() if v})


def test_nested_budgets(spark):
    """A larger target of the same source only adds documents."""
    rows = [(i, "w " * (1 + i % 9), "en", "a" if i % 2 else "b", 0) for i in range(600)]
    df = spark.createDataFrame(rows, DOCS)
    low = {r["doc_id"] for r in mix_sources(df, weights=(1, 5, 1)).collect() if r["source"] == "a" and r["taken"]}
    high = {r["doc_id"] for r in mix_sources(df, weights=(2, 5, 1)).collect() if r["source"] == "a" and r["taken"]}
    assert low < high


def test_empty_wordless_and_clashing(spark):
    assert mix_sources(spark.createDataFrame([], DOCS)).count() == 0
    out = mix_sources(spark.createDataFrame([(1, None, "en", "a", 0), (2, " ", "en", None, 0)], DOCS)).collect()
    assert all(r["target"] == 0 and r["taken"] == 0 for r in out) and len(out) == 2
    df = spark.createDataFrame([(1, "a b", "s", "x", 7)], "doc_id long, text string, source string, size string, taken int")
    assert mix_sources(df).first()["size"] == 2
