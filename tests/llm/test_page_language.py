import math
import random
from collections import Counter, defaultdict

from conftest import SF_CHECK
from pyspark.sql import functions as F

from playstats.llm.langid import BINS, OUTSIDE, SMOOTH, TEMPER, identify_languages
from playstats.llm.page_language import page_evidence, page_languages, visible_text

PAGES = "page_id long, url string, html string"
VOCAB = {"en": "the of and that with from this which have their".split(), "de": "der die und nicht eine von sich auch wird über".split(),
         "fr": "les des une dans pour que est avec sont été".split()}


def trigrams(text):
    """Bins of the trigrams, one byte at a time: letters folded, one word end in a row, none with the end in the middle."""
    folded = []
    for b in (" " + (text or "") + " ").encode():
        b = b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
        if not (b == 32 and folded and folded[-1] == 32):
            folded.append(b)
    return [((a * 65536 + b * 256 + c) * 2654435761 % 2 ** 32) >> (32 - int(math.log2(BINS)))
            for a, b, c in zip(folded, folded[1:], folded[2:]) if b != 32]


def plain_posteriors(rows):
    """{id: (language, probability)} of (id, text, declared, host, suffix, path), by the definitions alone."""
    langs = sorted({r[2] for r in rows if r[2]})
    counts = {x: Counter() for x in langs}
    for _, text, declared, *_ in rows:
        if declared:
            counts[declared].update(trigrams(text))
    total = {x: sum(counts[x].values()) + 0.5 * BINS for x in langs}
    text_score, best = {}, {}
    for i, text, *_ in rows:
        bins = trigrams(text)
        cut = min(1.0, TEMPER / len(bins)) if bins else 0.0
        text_score[i] = [cut * sum(math.log((counts[x][b] + 0.5) / total[x] * BINS) for b in bins) for x in langs]
        best[i] = langs[text_score[i].index(max(text_score[i]))] if bins and max(text_score[i]) > 0 else None
    scores = {i: list(s) for i, s in text_score.items()}
    outside = {r[0]: math.log(OUTSIDE) for r in rows}
    for kind in (2, 4, 5):
        seen = Counter((r[kind], best[r[0]]) for r in rows if r[kind] is not None and best[r[0]])
        values = len({v for v, _ in seen})
        below = {x: sum(n for (_, y), n in seen.items() if y == x) + values + 1 for x in langs}
        for r in rows:
            if any(v == r[kind] for v, _ in seen):
                scores[r[0]] = [s + math.log((seen[r[kind], x] + 1) / below[x]) for s, x in zip(scores[r[0]], langs)]
                shown = 0 if kind == 2 else sum(n for (v, _), n in seen.items() if v == r[kind])
                outside[r[0]] += math.log((shown + 1) / (sum(seen.values()) + values + 1))
    held = defaultdict(Counter)
    for r in rows:
        if r[3] is not None and best[r[0]]:
            names = r[3].split(".")
            for at in range(len(names)):
                held[".".join(names[at:])][best[r[0]]] += 1
            held[None][best[r[0]]] += 1
    full = {r[3] for r in rows if best[r[0]]}
    for r in rows:
        if r[3] is not None and r[3] in full:
            prior = [(held[None][x] + 1) / (sum(held[None].values()) + len(langs)) for x in langs]
            names = r[3].split(".")
            for at in reversed(range(len(names))):
                level = held[".".join(names[at:])]
                prior = [(level[x] + SMOOTH * p) / (sum(level.values()) + SMOOTH) for x, p in zip(langs, prior)]
            scores[r[0]] = [s + math.log(p) for s, p in zip(scores[r[0]], prior)]
    out = {}
    for r in rows:
        top = max(scores[r[0]])
        share = 1 / (math.exp(outside[r[0]] - top) + sum(math.exp(s - top) for s in scores[r[0]]))
        out[r[0]] = (langs[scores[r[0]].index(top)], share) if trigrams(r[1]) else ("und", 0.0)
    return out


def evidence_rows(n=120):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(VOCAB))
        other = rnd.choice(list(VOCAB))
        text = " ".join(rnd.choice(VOCAB[lang]) for _ in range(rnd.choice([1, 2, 3, 30])))
        rows.append((i, text, rnd.choice([lang, lang, other, None]), rnd.choice([f"{lang}.site.{lang}", "mixed.org", "a.mixed.org", None]),
                     rnd.choice([lang, other, "org", None]), rnd.choice([lang, "img", None])))
    return rows + [(n, None, "en", "mixed.org", "org", None), (n + 1, "123 !", "de", None, None, "de"),
                   (n + 2, "xyzzy plugh", None, "de.site.de", "de", "de"), (n + 3, "qqq zzz", None, None, None, None)]


def test_posteriors_equal_a_plain_version(spark):
    rows = evidence_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, declared string, host string, suffix string, path string")
    out = identify_languages(df, declared_col="declared", host_col="host", suffix_col="suffix", path_col="path").collect()
    want = plain_posteriors(rows)
    assert len(out) == len(rows)
    for r in out:
        language, probability = want[r["doc_id"]]
        assert r["language"] == language and abs(r["probability"] - probability) < 1e-9, r
        assert r["accepted"] == (language != "und" and probability >= 0.5)


def test_evidence_of_pages(spark):
    rows = [(1, "https://u@M.X.example.FR:80/de-AT/a?b", '<!-- <html> --><HTML class="x" data-lang="no" lang="pt-BR"><p>a&eacute;</p>'),
            (2, "http://10.0.0.1/img/x", '<meta http-equiv="Content-Language" content="sv">text'),
            (3, "no address", "<html xml:lang=it>a<script>if (a < b) 'x'</script>b<style>p{}"),
            (4, None, None), (5, "http://localhost", ""), (6, "http://a.com./english/", '<a hreflang="xx">y</a>')]
    out = {r["page_id"]: r for r in page_evidence(spark.createDataFrame(rows, PAGES)).collect()}
    got = {i: (r["declared"], r["host"], r["suffix"], r["path"]) for i, r in out.items()}
    assert got == {1: (None, "m.x.example.fr", "fr", "de-at"), 2: ("sv", "10.0.0.1", None, "img"), 3: ("it", None, None, None),
                   4: (None,) * 4, 5: (None, "localhost", None, None), 6: (None, "a.com", "com", None)}
    assert out[1]["text"].split() == ["aé"] and out[3]["text"].split() == ["a", "b"] and out[4]["text"] is None
    marked = spark.createDataFrame([(1, "", '<html class="x" data-lang="no" lang="pt-BR">')], PAGES)
    assert page_evidence(marked).first()["declared"] == "pt-BR"


def test_unclosed_markup_takes_linear_time():
    assert visible_text("a <script> b" * 20000).split() == ["a"]
    assert visible_text("a <!-- b" * 20000).split() == ["a"]
    assert visible_text("1 < 2 <b" + " x" * 100000).split() == ["1", "<", "2"]


def test_each_kind_of_evidence_can_decide(spark):
    rnd = random.Random(3)

    def page(lang, n=40):
        return f'<html lang="{lang}">' + " ".join(rnd.choice(VOCAB[lang]) for _ in range(n))

    rows = [(i, f"http://h{i % 7}.site.{x}/{x}/{i}", page(x)) for i in range(240) for x in [list(VOCAB)[i % 3]]]
    rows += [(300 + i, f"http://p{i}.org/", page(list(VOCAB)[i % 3])) for i in range(60)]        # org says nothing
    rows += [(900, "http://new.org/1", '<html lang="de">jqjq'), (901, "http://new.de/1", "xyzzy"), (902, "http://new.org/fr/1", "xyzzy"),
             (903, "http://h1.site.fr/1", "xyzzy")]
    out = {r["page_id"]: r["language"] for r in page_languages(spark.createDataFrame(rows, PAGES)).collect()}
    assert [out[i] for i in range(900, 904)] == ["de", "de", "fr", "fr"]


def test_awkward_pages(spark):
    clash = "page_id long, url string, html string, text string, best int, host int"
    rows = [(1, None, None, "x", 1, 2), (2, "http://a.b/", "", "x", 1, 2), (None, "http://a.b/", '<html lang="en">the words', "x", 1, 2)]
    rows += [(7, "http://a.b/en/", '<html lang="en">' + "the words of this page " * 50_000, None, None, None)] * 2
    out = page_languages(spark.createDataFrame(rows, clash)).collect()
    assert sorted((r["page_id"] or 0, r["language"], r["accepted"]) for r in out) == [
        (0, "en", True), (1, "und", False), (2, "und", False), (7, "en", True), (7, "en", True)]
    assert page_languages(spark.createDataFrame([], PAGES)).count() == 0


def test_languages_of_the_test_pages(spark):
    pages = spark.read.parquet(f"{SF_CHECK}/pages.parquet")
    true = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    hidden = pages.withColumn("true", true).withColumn("html", F.when(F.col("page_id") % 5 != 0, F.col("html")).otherwise(
        F.regexp_replace("html", "<html[^>]*>", "<html>")))
    out = page_languages(hidden).join(hidden.select("page_id", "true"), "page_id").collect()
    held = [r for r in out if r["page_id"] % 5 == 0]
    assert len(out) == pages.count() and all(r["declared"] is None for r in held)
    assert sum(r["language"] == r["true"] for r in held) >= 0.98 * len(held)


def test_batches_of_pages_are_bounded_by_bytes(spark):
    """1,500 pages of 40 KB: a Python worker gets 8 MB or so at a time, not all of a partition."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from playstats.llm import page_language
    pages = spark.range(0, 1500, 1, 1).select(F.col("id").alias("page_id"), F.lit("http://a.de/").alias("url"),
                                              F.concat(F.lit("<html lang=de>"), F.repeat(F.lit("ab c "), 8000)).alias("html"))
    out = page_languages(pages)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    assert pages.select("html").mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 10_000_000
    assert out.count() == 1500 and {r["language"] for r in out.collect()} == {"de"}
    got = page_language._visible.func(pa.array(["<b>x</b>", None, "y" * 9_000_000, ""]))
    assert [None if v is None else len(v) for v in got.to_pylist()] == [3, None, 9_000_000, 0]
    assert page_language._visible.func(pa.array([], pa.string())).to_pylist() == []
