import zlib
from collections import defaultdict

from helpers import DOCS, awkward_docs
from pyspark.sql import functions as F

from playstats.llm.sharding import kd_shards, metadata_points, shard_documents, write_shards


def check(out, rows, shards):
    assert len(out) == len(rows)
    by_shard = defaultdict(list)
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    for r in out:
        sizes = {len((t or "").encode()) + 1 for t in texts[r["doc_id"]]}
        assert r["size"] in sizes and r["law"] == "bytes" and r["grown_shard"] is None
        assert r["text_crc32"] in {zlib.crc32((t or "").encode()) for t in texts[r["doc_id"]]}
        assert 0 <= r["shard"] < shards
        by_shard[r["shard"]].append(r)
    for rs in by_shard.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    return {s: sum(r["size"] for r in rs) for s, rs in by_shard.items()}


def test_awkward_rows(spark):
    rows = awkward_docs()
    out = shard_documents(spark.createDataFrame(rows, DOCS)).collect()
    check(out, rows, 8)


def test_near_equal_bytes_with_a_hot_source(spark):
    rows = [(i, "x" * (1 + i * 37 % 400), "en" if i % 5 else "de", "hot" if i % 3 else f"s{i % 11}", 0)
            for i in range(4000)]
    for shards in (8, 5):
        bytes_ = check(shard_documents(spark.createDataFrame(rows, DOCS), shards=shards).collect(), rows, shards)
        assert len(bytes_) == shards
        assert max(bytes_.values()) - min(bytes_.values()) <= 3 * 402     # a document a cut on the way


def test_same_metadata_everywhere(spark):
    rows = [(i, "same text", "en", "s", 0) for i in range(800)]
    bytes_ = check(shard_documents(spark.createDataFrame(rows, DOCS)).collect(), rows, 8)
    assert max(bytes_.values()) - min(bytes_.values()) <= 30


def test_empty_single_and_clashing(spark):
    assert shard_documents(spark.createDataFrame([], DOCS)).count() == 0
    df = spark.createDataFrame([(1, "a", "en", "s", "old", 5)], "doc_id long, text string, lang string, source string, shard string, size int")
    assert shard_documents(df).first()["slot"] == 0


def test_reruns_agree_and_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}" * (i % 9 + 1), "en", "s", 0) for i in range(300)], DOCS)
    a = {(r["doc_id"], r["shard"], r["slot"]) for r in shard_documents(docs).collect()}
    b = {(r["doc_id"], r["shard"], r["slot"]) for r in shard_documents(docs.repartition(7)).collect()}
    assert a == b
    write_shards(docs, shard_documents(docs), f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in back.select("doc_id", "shard", "slot").collect()} == a
    assert back.select(F.countDistinct("doc_id")).first()[0] == 300


def plain_tree(rows, dims, shards):
    """Shard of each row (``size``, tie, ordinates by dimension) by recursion over sorted rows."""
    span = {d: max(1, max(r[d] for r in rows) - min(r[d] for r in rows)) for d in dims}
    place = {}

    def split(part, first, k):
        if k == 1 or not part:
            place.update({r["doc_id"]: first for r in part})
            return
        d = max(dims, key=lambda x: (max(r[x] for r in part) - min(r[x] for r in part)) / span[x])
        weight = defaultdict(int)
        for r in part:
            weight[r[d], r["_kd_tie"]] += r["size"]
        need, run = sum(weight.values()) * (k // 2) / k, 0
        left = set()
        for key in sorted(weight):
            if run + weight[key] >= need:
                if (need - run) * 2 >= weight[key]:
                    left.add(key)
                break
            left.add(key)
            run += weight[key]
        split([r for r in part if (r[d], r["_kd_tie"]) in left], first, k // 2)
        split([r for r in part if (r[d], r["_kd_tie"]) not in left], first + k // 2, k - k // 2)

    split(rows, 0, shards)
    return place


def test_tree_equals_a_plain_one(spark):
    rows = [(i, None if i % 50 == 0 else "x" * (i * i % 700), ("en", "de", "fr", None)[i * 7 % 4],
             "hot" if i % 3 else f"http://site{i % 40}.example/long/prefix", 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, DOCS)
    for shards, numeric in ((8, ()), (5, ("doc_id",))):
        slim, dims = metadata_points(docs, ["doc_id"], "doc_id", "text", numeric, ("lang", "source"))
        points = [r.asDict() for r in slim.collect()]
        got = {r["doc_id"]: r["shard"] for r in kd_shards(slim, dims, shards, tolerance=0.0).collect()}
        assert got == plain_tree(points, dims, shards)
        used = {d: {r[d] for r in points} for d in dims}
        assert used["_kd_s0"] == {0, 1, 2, 3}
        assert len(used["_kd_s1"]) == len({r[3] for r in rows})      # labels alike in their first bytes differ


def test_ordinates_keep_the_order_of_numbers(spark):
    inf = float("inf")
    values = [None, float("nan"), -inf, -1.7e308, -5.0, 0.0, 3.0, 1.7e308, inf]
    docs = spark.createDataFrame([(i, "t", v) for i, v in enumerate(values)], "doc_id long, text string, n double")
    slim, _ = metadata_points(docs, ["doc_id"], "doc_id", "text", ("n",), ())
    at = [r["_kd_n0"] for r in slim.orderBy("doc_id").collect()]
    assert at[0] == at[1] == 0 and at[2] == at[3] == 1 and at[7] == at[8] == (1 << 31) - 1
    assert at[2:] == sorted(at[2:])
    assert shard_documents(docs, numeric=("n",), labels=()).count() == len(values)
