import html
import random
from collections import Counter
from urllib.parse import urljoin

from pyspark.sql import functions as F

from playstats.llm import queries
from playstats.llm.components import connected_components
from playstats.llm.urlfilter import COMPILED_RULES, RULES, Rule, _unescape, canonical_form, filter_urls, match_rules, resolve

PAGES = "page_id long, url string, html string"
LINK = '<html><head><LINK href="{}" rel="canonical"></head>'
JUMP = "<meta http-equiv='refresh' content='0; URL={}'>"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = lambda s, stops: s[:min([s.find(c) for c in stops if c in s], default=len(s))]
    host = cut(rest, "/?#")
    low = "".join(c.lower() if c.isascii() else c for c in host)
    return low, cut(rest[len(host):], "?#")


def explicit(url, rules=RULES):
    host, path = parts(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    return (host, path, best and best.name, best and best.verdict)


def judge(spark, rows, **kw):
    return {r["page_id"]: r for r in filter_urls(spark.createDataFrame(rows, PAGES), **kw).collect()}


def test_rules(spark):
    urls = ["http://a.net/x", "https://Example.NET/en/1", "http://x.example.net/EN/1", "http://example.net/en", "ftp://a.example.com/de/1",
            "http://example.com/fr/", "http://b.org/fr/1#x", "http://borg/fr/1", "http://net/", "http://net", "http://a.net?x=/",
            "http://a.net#/", None, "", "no address", "http://", "://a.net/", "http://u.com/?q=http://a.net/x", "http://Ünet.net/É\nb",
            "http://example.net/en/?a=1", "http://notexample.com/de/", "http://A.NET/a?b#c"]
    out = judge(spark, [(i, u, None) for i, u in enumerate(urls)])
    for i, u in enumerate(urls):
        host, path, rule, verdict = explicit(u)
        assert (out[i]["host"], out[i]["path"], out[i]["rule"]) == (host, path, rule), u
        if rule or not host:
            assert out[i]["verdict"] == (verdict or "allow")
    assert out[9]["verdict"] == "block"      # http://net is an alias of http://net/


def test_blocks_reach_aliases_and_allow_wins(spark):
    rows = [(1, "http://a.com/1", LINK.format("http://bad.net/1")),                 # linked to a blocked page
            (2, "http://bad.net/1", ""),
            (3, "http://b.com/1", JUMP.format("http://a.com/1")),                   # two steps away
            (4, "http://c.com/1", LINK.format("http://bad.net/2")), (5, "http://bad.net/2", None),
            (6, "http://d.org/fr/1", LINK.format("http://c.com/1")),                # an allow in the same component
            (7, "http://e.com/1", "<html>"), (8, "http://www.a.com/1/?utm_source=x#y", ""),   # canonical form of 1
            (9, "http://a.com/1", LINK.format("http://bad.net/1"))]                 # repeated row
    out = judge(spark, rows)
    assert [out[i]["verdict"] for i in range(1, 10)] == [
        "block", "block", "block", "allow", "block", "allow", "allow", "block", "block"]
    assert out[1]["rule"] is None and out[5]["rule"] == "net/"


def test_blocked_page_that_is_not_in_the_table_decides_nothing(spark):
    assert judge(spark, [(1, "http://a.com/1", LINK.format("http://bad.net/1"))])[1]["verdict"] == "allow"


def test_redirect_table(spark):
    pages = [(1, "http://a.com/1", ""), (2, "http://x.net/1", ""), (3, "http://q.com/", "")]
    hops = spark.createDataFrame([("http://a.com/1", "http://mid.com/"), ("http://mid.com/", "http://x.net/1"),
                                  (None, "http://x.net/1"), ("http://q.com/", None)], "from_url string, to_url string")
    out = judge(spark, pages, redirects=hops)
    assert out[1]["verdict"] == "block" and out[3]["verdict"] == "allow"


def test_hot_alias_group(spark):
    rows = [(i, f"http://h{i}.com/", LINK.format("http://hub.com/")) for i in range(400)] + [(999, "http://z.net/", LINK.format("http://hub.com/"))]
    assert Counter(r["verdict"] for r in judge(spark, rows).values()) == {"block": 401}


def test_canonical_form(spark):
    same = ["http://a.com/x", "https://www.A.com/x/", "http://m.a.com/x.html#top", "http://a.com/x?utm_source=f&ref=x",
            "http://a.com/x/index.html", "http://a.com/x?"]
    other = ["http://a.com/X", "http://a.com/x?page=2", "http://b.com/x", "http://a.com/x/y"]
    df = spark.createDataFrame([(u,) for u in same + other], "url string")
    got = [r[0] for r in df.select(canonical_form(df.url)).collect()]
    assert len(set(got[:len(same)])) == 1 and got[0] == "a.com/x" and len(set(got)) == 1 + len(other)


def test_empty_clashing_and_rules(spark):
    assert filter_urls(spark.createDataFrame([], PAGES)).count() == 0
    df = spark.createDataFrame([(1, "http://a.net/", None, "old", 3)], PAGES + ", verdict string, node int")
    row = filter_urls(df).first()
    assert row["verdict"] == "block" and row["node"] == 3
    rules = (Rule("block", "a.com", ""), Rule("allow", "a.com", "/ok"))
    out = judge(spark, [(1, "http://a.com/ok/1", ""), (2, "http://a.com/no", "")], rules=rules)
    assert (out[1]["verdict"], out[2]["verdict"]) == ("allow", "block")


def test_no_python_in_the_plan(spark):
    df = filter_urls(spark.createDataFrame([(1, "http://a.net/", "")], PAGES).repartition(2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_components_against_union_find(spark):
    import random
    rnd = random.Random(3)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1064)]
    edges += [(2000, 2000 + i) for i in range(1, 200)] + [(5, 5), (None, 3), (4, None)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in parent} and len(got) == len(parent)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_relative_and_variant_targets(spark):
    base = "http://a.com/d/e/page?x=1#f"
    links = ["/new", "page2.html", "//host.com/p", "../up", "../../../top", "./", "..", "?q=2", "#z", "http://b.com/x/../y?a=1&amp;b=2",
             "/a?u=http://c.com/", "mailto:x@y.z", "javascript:go()", "&#x2F;caf&eacute;&#47;&#233;", "/s?a=1&copy=2&copy;&lt", "g;x=1/../y", "/&#128;&#0;"]
    df = spark.createDataFrame([(x,) for x in links], "link string")
    got = [r[0] for r in df.select(resolve(_unescape(df.link), F.lit(base))).collect()]

    def python(x):
        full = urljoin(base, html.unescape(x).replace("b.com/x/../y", "b.com/y") if "copy" not in x else "/s?a=1&copy=2©<")   # an attribute's &copy= is no reference
        return full if "://" in full.split("?")[0] else None
    assert got == [python(x) for x in links]
    rows = [(1, "http://bad.net/1", ""), (2, "http://bad.net/dir/2", ""),
            (3, "http://a.com/3", LINK.format("//bad.net/1")), (4, "http://www.a.com/x/4", JUMP.format("/old/../3")),
            (5, "http://a.com/old/5", LINK.format("../3?utm_source=a&amp;ref=b")), (6, "http://a.com/6", LINK.format("https://www.bad.net/dir/2/")),
            (7, "http://a.com/7", '<base href="//bad.net/dir/">' + LINK.format("2")), (8, "http://a.com/8", LINK.format("mailto:9")),
            (9, "http://a.com/9", LINK.format("/8"))]
    out = judge(spark, rows)
    assert [out[i]["verdict"] for i in range(1, 10)] == ["block"] * 7 + ["allow"] * 2


def test_redirect_ends_meet_pages_by_their_forms(spark):
    pages = [(1, "http://a.com/1", ""), (2, "http://x.net/1", ""), (3, "http://q.com/in", ""), (4, "http://z.com/1", "")]
    hops = spark.createDataFrame([("https://www.a.com/1/", "http://www.x.net/1"), ("http://q.com/out", "in"), ("http://z.com/2", "in"),
                                  ("http://q.com/out", "//x.net/1"), ("odd", "http://x.net/1"), ("odd", "http://z.com/1")], "from_url string, to_url string")
    out = judge(spark, pages, redirects=hops)
    assert [out[i]["verdict"] for i in range(1, 5)] == ["block", "block", "block", "allow"]


def test_rules_reach_targets_that_are_no_pages(spark, tmp_path):
    pages = [(1, "http://a.com/1", LINK.format("http://bad.net/1")), (2, "http://b.com/1", ""),
             (3, "http://c.com/1", JUMP.format("http://d.org/fr/1")), (4, "http://e.net/1", LINK.format("http://c.com/1")),
             (5, "http://f.com/1", LINK.format("http://c.com/1")), (6, "http://g.com/1", LINK.format("http://h.com/1"))]
    hops = spark.createDataFrame([("http://b.com/1", "http://mid.com/"), ("http://mid.com/", "http://x.net/gone")], "from_url string, to_url string")
    out = judge(spark, pages, redirects=hops, judge_targets=True)
    assert [out[i]["verdict"] for i in range(1, 7)] == ["block", "block", "allow", "block", "allow", "allow"]
    spark.createDataFrame(pages, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    query = {r["page_id"]: r["verdict"] for r in queries.op10_url_filter(spark, str(tmp_path)).collect()}
    assert query == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "allow"}


def test_long_lists_and_tables_of_rules(spark):
    """A thousand rules and a table of rules give what the plain search over all rules gives."""
    rnd = random.Random(5)
    hosts = ["net", "com", "a.net", "b.a.net", "é.net", "😀.com", "x"] + [f"h{i}.com" for i in range(60)]
    paths = ["/", "/a", "/a/", "/a/b", "/é", ""] + [f"/a/{i}" for i in range(40)]
    names = sorted({(rnd.choice(hosts), rnd.choice(paths)) for _ in range(1400)})
    rules = tuple(Rule(rnd.choice(["block", "allow"]), h, p) for h, p in names)
    assert len(rules) > COMPILED_RULES
    urls = [None, "", "none", "http://", "http://.net/a", "http://net", "http://" + "a." * 2000 + "net/" + "a/" * 3000]
    urls += [f"http://{rnd.choice(['', 'www.', 'q.', 'b.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', '1', '/b?x', '#y'])}"
             for _ in range(400)]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls + urls[:50])], PAGES)

    def plain(url):
        host, path = parts(url)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = min(fit, key=lambda r: (-len(r.name), r.verdict != "block", r.name), default=None)
        return best and best.name, best and best.verdict

    table = spark.createDataFrame([(r.host, r.path, r.verdict) for r in rules] + [(None, "/", "block"), ("net", None, "block")],
                                  "host string, path string, verdict string")
    for given in (rules, table):
        out = match_rules(pages, given).collect()
        assert len(out) == len(urls) + 50
        for r in out:
            assert (r["rule"], r["verdict"]) == plain(r["url"]), r["url"]
    both = spark.createDataFrame([("net", "/", "allow"), ("net", "/", "block")], "host string, path string, verdict string")
    assert judge(spark, [(1, "http://a.net/x", None)], rules=both)[1]["verdict"] == "block"
    none = both.limit(0)
    assert judge(spark, [(1, "http://a.net/x", None)], rules=none)[1]["verdict"] == "allow"
