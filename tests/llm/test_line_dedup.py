import hashlib
from collections import Counter, defaultdict

from helpers import DOCS, WS, ascii_lower, awkward_docs
from pyspark.sql import functions as F

from playstats.llm.line_dedup import line_dedup


def brute(rows, min_chars=40, min_docs=5):
    holders = defaultdict(set)
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            key = ascii_lower(line.strip(WS))
            if len(key) >= min_chars and doc is not None:
                holders[key].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            key = ascii_lower(line.strip(WS))
            if len(holders.get(key, ())) < min_docs or doc == max(holders[key]):
                kept.append(line)
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_against_brute_force(spark):
    rows = awkward_docs() + [(None, awkward_docs()[0][1], "en", "a", 1)]
    out = line_dedup(spark.createDataFrame(rows, DOCS)).select(
        "doc_id", "n_lines", "n_dropped", F.coalesce("text", F.lit(""))).collect()
    want = brute(rows)
    assert Counter(map(tuple, out)) == Counter(want)
    assert sum(r[2] for r in want) > 5


def test_reassembly_keeps_order_and_blank_lines(spark):
    shared = "x" * 45
    rows = [(i, f"a{i}\n\n{shared}\r\nb{i}\n{shared.upper()} \n", "en", "s", 0) for i in range(6)]
    out = {r["doc_id"]: r for r in line_dedup(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[0]["text"] == "a0\n\nb0\n" and out[0]["n_dropped"] == 2 and out[0]["n_lines"] == 6
    assert out[5]["text"] == rows[5][1] and out[5]["n_dropped"] == 0


def test_thresholds(spark):
    rows = [(i, "y" * 39, "en", "s", 0) for i in range(9)] + [(20 + i, "z" * 40, "en", "s", 0) for i in range(4)]
    assert line_dedup(spark.createDataFrame(rows, DOCS)).agg(F.sum("n_dropped")).first()[0] == 0


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert line_dedup(empty).count() == 0
    df = spark.createDataFrame([(1, "a\nb", "p", "q")], "doc_id long, text string, n_lines string, _x string")
    row = line_dedup(df).first()
    assert row["n_lines"] == 2 and row["_x"] == "q" and row["text"] == "a\nb"


def test_hash_of_kept_text(spark):
    text = "é\nb"
    got = line_dedup(spark.createDataFrame([(1, text, "en", "s", 0)], DOCS)).select(F.sha2("text", 256)).first()[0]
    assert got == hashlib.sha256(text.encode()).hexdigest()
