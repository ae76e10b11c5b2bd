from collections import Counter

import corpus_pipeline
from conftest import SF_SMALL
from helpers import DOCS, awkward_docs
from test_line_dedup import brute as brute_lines
from test_neardup import brute as brute_groups

import __spark_entry__ as entry


def test_stages_follow_one_another(spark, tmp_path):
    rows = awkward_docs()
    docs = spark.createDataFrame(rows, DOCS)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "near_dedup", "mix", "pack"]
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language_id"](spark, docs, "")
    assert kept.columns == docs.columns and kept.count() == len(rows) - 3
    kept_rows = [tuple(r) for r in kept.collect()]

    lined = stages["line_dedup"](spark, kept, "")
    assert lined.columns == docs.columns
    lined_rows = [tuple(r) for r in lined.collect()]
    assert Counter((r[0], r[1]) for r in lined_rows) == Counter((d, t) for d, _, _, t in brute_lines(kept_rows))
    assert all(r[4] == len(r[1]) for r in lined_rows)

    single = stages["near_dedup"](spark, lined, "")
    want = {d for d, _, _, k in brute_groups(lined_rows, 5, 80) if k}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    mixed = stages["mix"](spark, single, "")
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} <= want
    packed = stages["pack"](spark, mixed, "")
    assert Counter(r["doc_id"] for r in packed.collect() if r["piece"] == 0) == Counter(r["doc_id"] for r in mixed.collect())


def test_run_and_empty_documents(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF_SMALL).count() > 100
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered(spark):
    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(entry.oracle_sql()) <= names


def test_near_dedup_keeps_rows_without_an_id_of_their_own(spark):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(30))
    rows = [(None, text(i), "en", "s", 1) for i in range(20)]                      # distinct texts, no id
    rows += [(None, text(5) + " more", "en", "t", 1), (None, text(6), "en", "t", 1)]   # copies of them
    rows += [(7, text(100), "en", "s", 1), (7, text(101), "en", "s", 1), (7, text(101), "en", "s", 1)]
    rows += [(3, text(7), "en", "s", 1), (8, text(7), None, "s", 1), (8, text(7), "s", None, 1)]
    near_dedup = dict(corpus_pipeline.STAGES)["near_dedup"]
    for parts in (1, 5):
        out = near_dedup(spark, spark.createDataFrame(rows, DOCS).repartition(parts), "")
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        got = [tuple(r)[:2] for r in out.collect()]
        groups = {t.split()[0]: d for d, t in got}
        assert len(got) == len(groups) == 22
        assert groups["w7x0"] == 3 and groups["w100x0"] == groups["w101x0"] == 7
        assert sum(d is None for d in groups.values()) == 19
