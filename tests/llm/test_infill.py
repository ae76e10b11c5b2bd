import hashlib
import random
import re

from helpers import DOCS, awkward_docs, by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from playstats.llm.infill import BlockIndex, fill_in_middle, restored

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) from the list of all units."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(m), "<P>" + p + "<S>" + s + "<M>" + m


def marker_docs():
    """Texts that hold markers, halves of markers at every cut, and letters over block borders."""
    rnd = random.Random(3)
    odd = ["<P>", "a<S>b", "<M>" * 3, "<", "<P", "P>", "<<P", "S>>", "<p>", "<P<S<M", "><><", "\x00", "\U0001F389x", "é", "\r\n"]
    rows = [(1000 + i, t, "en", "a", 1) for i, t in enumerate(odd)]
    rows += [(2000 + i, "".join(rnd.choice(["<", "P", "S", "M", ">", "a", " ", "é", "日", "\n"]) for _ in range(rnd.randint(0, 60))),
              "en", "a", 1) for i in range(300)]
    rows += [(3000, "x" * 20_000, "en", "a", 1), (3001, "ab " * 9000, "en", "a", 1), (None, "no id here", "en", "a", 1),
             (None, None, None, None, None), (-5, "minus five", "en", "a", 1)]
    return rows


def test_equals_brute_force_and_restores(spark):
    rows = awkward_docs() + marker_docs()
    for block in (4096, 7):
        out = restored(fill_in_middle(spark.createDataFrame(rows, DOCS), block=block)).collect()
        want = [(i, *brute(i, t), t or "") for i, t, *_ in rows]
        assert by_id(map(tuple, out)) == by_id(want)
    forms = {r["form"] for r in out}
    assert forms == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ é日<>1\n", max_size=60), st.integers(1, 9))
def test_descent_finds_every_boundary(text, block):
    index = BlockIndex(text, block)
    units = UNIT.findall(text)
    assert index.total() == len(units)
    at = 0
    for i, u in enumerate([*units, ""]):
        assert index.locate(i) == at
        at += len(u)


def test_empty_table_and_clashing_columns(spark):
    assert fill_in_middle(spark.createDataFrame([], DOCS)).count() == 0
    clash = spark.createDataFrame([(1, "two words", 5, "x", "y")], "doc_id long, text string, n int, form string, output string")
    (row,) = restored(fill_in_middle(clash)).collect()
    assert row["n"] == 3 and row["restored"] == "two words"


def test_query_on_tables(spark):
    from playstats.llm.queries import op11_fill_in_middle
    out = op11_fill_in_middle(spark, "/root/testdata/sf0.001")
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in texts.select("doc_id", "text").collect()}
    assert {(r["doc_id"], r["restored_sha256"]) for r in out.collect()} == want
