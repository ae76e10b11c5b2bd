"""URL filters: host and path rules, with block decisions carried to redirect aliases.

Rules name a host (which fits itself and all its subdomains) and a path prefix; the longest
fitting rule decides. Short lists are compiled into one expression; long lists and tables of rules are
joined by host suffix and path prefix, with the same result. Pages without a fitting rule take part in redirect equivalence: redirect
and canonical-link edges join addresses to components, and a block inside a component
reaches the members that no rule covers, unless the component also holds an explicit allow,
which takes precedence. All else is allowed. With ``judge_targets`` the rules are also matched on
the other ends of the edges (link targets, both ends of redirects), so that a verdict on an address
that is no page reaches its aliases; without it only pages have explicit verdicts.

Edges of a page: its address to the target of ``<link rel="canonical">`` and to the target of a
``<meta http-equiv="refresh">`` redirect; a table of observed redirects (``from_url``, ``to_url``)
may be given too. Targets are unescaped (HTML character references) and resolved against the page's
``<base>`` or address, ``to_url`` against ``from_url``: scheme-, root- and path-relative ones and
dot segments. Every end of an edge is joined to its canonical form (scheme, ``www.``/``m.`` labels,
fragment, tracking parameters, dot segments, a closing ``/``, ``index`` page or ``.html`` are dropped).

Defined results. A null address, or one without ``://``, has an empty host and path, fits
no rule, has no edges and is allowed; a null page has no links, and a target that is no address
with ``://`` once resolved (``mailto:``, an empty one) is no edge. Repeated rows are judged
alike. An empty table gives an empty result. Input columns named like the output
columns are replaced. Everything is DataFrame operations. Nodes are 128-bit MD5 values, so
long addresses do not travel; the component table has a row for each address with an edge.
"""

from __future__ import annotations

import html
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm.common import lower_ascii, write_once
from playstats.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str   # block or allow
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))
# Lists of up to so many rules are one expression; longer ones, and tables of rules, are joined.
COMPILED_RULES = 500
OUT = ("host", "path", "rule", "verdict")

_HREF = r"(?is)(?<![\w-])href\s*=\s*[\"']?([^\"'\s>]+)"
_BASE = (r"(?is)<base\s[^>]*>", _HREF)
_CANONICAL = (r"(?is)<link\s[^>]*?rel\s*=\s*[\"']?canonical[\"']?[^>]*>", _HREF)
_REFRESH = (r"(?is)<meta\s[^>]*?http-equiv\s*=\s*[\"']?refresh[\"']?[^>]*>", r"(?is)url\s*=\s*[\"']?([^\"'\s>]+)")
# character references by name, and those numbers that HTML reads as Windows-1252
_NAMED = json.dumps(html.entities.html5 | {f"#{n}": html.unescape(f"&#{n};") for n in range(128, 160)})
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_TRACKING = r"(?i)(?<=[?&])(utm_[a-z]+|ref|fbclid|gclid|sessionid)=[^&#]*&?"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + 3)), F.lit(""))


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _unescape(text: Column) -> Column:
    """``text`` (an attribute's value) with its character references replaced."""
    table = F.from_json(F.lit(_NAMED), "map<string,string>")

    def piece(x: Column) -> Column:
        """What follows an ``&``; a name without ``;`` counts if neither ``=`` nor a letter follows."""
        name = F.regexp_extract(x, r"^([A-Za-z][A-Za-z0-9]*(;|(?!=)))", 1)
        number = F.regexp_extract(x, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", 1)
        digits = F.ltrim(F.regexp_replace(number, "^[xX]", ""), F.lit("0"))
        code = F.when(F.length(digits) > 8, F.lit(0)).otherwise(F.coalesce(F.when(
            F.rlike(number, F.lit("^[xX]")), F.conv(digits, 16, 10)).otherwise(digits).try_cast("long"), F.lit(0)))
        char = _let(code, lambda c: F.when(
            (c == 0) | (c > 0x10FFFF) | c.between(0xD800, 0xDFFF), "\ufffd").otherwise(F.coalesce(
                F.try_element_at(table, F.concat(F.lit("#"), c.cast("string"))),
                F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))))
        named = F.concat(F.try_element_at(table, name), F.substr(x, F.length(name) + 1))
        return F.coalesce(
            F.when(number != "", F.concat(char, F.regexp_replace(x, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", ""))),
            F.when(name != "", named), F.concat(F.lit("&"), x))

    def joined(parts: Column) -> Column:
        return F.concat(F.element_at(parts, 1), F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), piece), ""))

    return F.when(F.instr(text, "&") > 0, _let(F.split(text, "&"), joined)).otherwise(text)


def _without_dots(path: Column) -> Column:
    """``path`` with its ``.`` and ``..`` segments resolved."""
    none = F.array().cast("array<string>")

    def step(a: Column, x: Column) -> Column:
        return F.when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.array_append(a, x))

    def folded(parts: Column) -> Column:
        closed = F.element_at(parts, -1).isin(".", "..")
        return _let(F.aggregate(F.slice(parts, 2, F.size(parts)), none, step), lambda a: F.concat(
            F.lit("/"), F.array_join(a, "/"), F.when(closed & (F.size(a) > 0), "/").otherwise("")))

    return _let(path, lambda p: F.when(F.rlike(p, F.lit(r"/\.\.?(/|$)")), _let(F.split(p, "/"), folded)).otherwise(p))


def _resolved(link: Column, base: Column) -> Column:
    root = F.regexp_extract(base, r"^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(path_of(base), "^$", "/"), r"[^/]*$", "")
    return (F.when(F.rlike(link, F.lit(_SCHEME + "//")), link)
            .when(F.rlike(link, F.lit(_SCHEME)) | (link == "") | (root == ""), None)
            .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(base, r"^(.*?:)//", 1), link))
            .when(F.startswith(link, F.lit("/")), F.concat(root, link))
            .when(F.startswith(link, F.lit("?")), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
            .when(F.startswith(link, F.lit("#")), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), link))
            .otherwise(F.concat(root, folder, link)))


def resolve(link: Column, base: Column) -> Column:
    """The address that ``link`` names on a page at ``base``; null if it is none with ``://``."""
    link = F.regexp_replace(link, r"^[\x00-\x20]+|[\t\n\r]|[\x00-\x20]+$", "")
    full = _let(base, lambda b: _let(link, lambda x: _resolved(x, b)))
    return _let(full, lambda f: F.concat(F.regexp_extract(f, r"^(.*?://[^/?#]*)", 1), _without_dots(path_of(f)),
                                         F.regexp_extract(f, r"^[^?#]*([\s\S]*)", 1)))


def canonical_form(url: Column) -> Column:
    """The address without scheme, www./m. labels, fragment, tracking parameters, dot segments and page suffix."""
    rest = F.regexp_replace(_rest(url), r"#[\s\S]*$", "")
    rest = F.regexp_replace(rest, _TRACKING, "")
    query = F.regexp_extract(rest, r"^[^?]*(\?[\s\S]*?)[?&]*$", 1)
    path = F.regexp_replace(_without_dots(F.regexp_extract(rest, r"^[^/?#]*([^?]*)", 1)),
                            r"(?i)(/index)?(\.html?)?/*$", "")
    host = F.regexp_replace(lower_ascii(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^((www|m)\.)+", "")
    return F.concat(host, path, F.when(query == "?", "").otherwise(query))


def _fits(rule: Rule, host: Column, path: Column) -> Column:
    name = F.lit(rule.host)
    return ((host == name) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def _rule_table(rules, spark: SparkSession) -> DataFrame:
    """(r_host, r_path, r_verdict), one row a host and path: of a block and an allow the block."""
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules], "verdict string, host string, path string")
    return write_once(rules.dropna(subset=["verdict", "host", "path"]).groupBy(
        F.col("host").alias("r_host"), F.col("path").alias("r_path")).agg(
            F.min_by("verdict", F.struct(F.col("verdict") != "block", "verdict")).alias("r_verdict")), "url-rules")


def _fit_by_join(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``pages`` plus rule and verdict, by equality joins on host suffixes and path prefixes.

    A host's suffixes are cut at the lengths that rules' hosts have, a path's prefixes at those of the
    rules of that host, so a host with many rules costs a page no more than it has lengths of paths.
    """
    lengths = [r[0] for r in rules.select(F.length("r_host")).distinct().collect()]   # as many as the longest host at most
    longest = rules.agg(F.max(F.length("r_path"))).first()[0] or 0
    hosts = rules.groupBy("r_host").agg(F.collect_set(F.length("r_path")).alias("_uf_lengths"))
    # a host has no slash and a path starts with one, so both together name the pair
    keyed = pages.withColumn("_uf_key", _node(F.concat("host", "path")))
    n = F.length("host")

    def label_starts(k: Column) -> Column:
        return (k == n) | ((k < n) & (F.substr("host", F.greatest(n - k, F.lit(1)), F.lit(1)) == "."))

    ends = (keyed.select("_uf_key", "host", F.substr("path", F.lit(1), F.lit(longest)).alias("_uf_start")).distinct()
            .withColumn("_uf_k", F.explode(F.filter(F.array(*[F.lit(k) for k in sorted(lengths)]).cast("array<int>"),
                                                    label_starts)))
            .select("_uf_key", "_uf_start", F.substr("host", n - F.col("_uf_k") + 1, F.col("_uf_k")).alias("_uf_host")))
    starts = (ends.join(hosts, F.col("_uf_host") == F.col("r_host"))
              .select("_uf_key", "_uf_host", "_uf_start", F.explode(F.filter(
                  "_uf_lengths", lambda k: k <= F.length("_uf_start"))).alias("_uf_k"))
              .select("_uf_key", "_uf_host", F.substr("_uf_start", F.lit(1), F.col("_uf_k")).alias("_uf_path")))
    name = F.concat("r_host", "r_path")
    best = (starts.join(rules, (F.col("_uf_host") == F.col("r_host")) & (F.col("_uf_path") == F.col("r_path")))
            .groupBy(F.col("_uf_key").alias("_uf_fit"))
            .agg(F.min(F.struct((-F.length(name)).alias("len"), (F.col("r_verdict") != "block").alias("late"),
                                name.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("_uf_best")))
    return (keyed.join(best, F.col("_uf_key") == F.col("_uf_fit"), "left")
            .withColumn("rule", F.col("_uf_best.rule")).withColumn("verdict", F.col("_uf_best.verdict"))
            .drop("_uf_key", "_uf_fit", "_uf_best"))


def match_rules(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, url_col: str = "url") -> DataFrame:
    """``pages`` plus host, path, rule (null if none fits) and the rule's verdict.

    ``rules`` may also be a table (verdict, host, path; rows with a null among these are no rule).
    """
    url = F.col(url_col)
    out = pages.select(*[c for c in pages.columns if c not in OUT], host_of(url).alias("host"),
                       path_of(url).alias("path"))
    if isinstance(rules, DataFrame) or len(rules) > COMPILED_RULES:
        return _fit_by_join(out, _rule_table(rules, pages.sparkSession))
    # longest first; of equally long ones a block goes first
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    rule = verdict = F.lit(None).cast("string")
    for r in reversed(ordered):
        fit = _fits(r, F.col("host"), F.col("path"))
        rule, verdict = F.when(fit, r.name).otherwise(rule), F.when(fit, r.verdict).otherwise(verdict)
    return out.withColumn("rule", rule).withColumn("verdict", verdict)


def _node(address: Column) -> Column:
    return F.unhex(F.md5(address))


def link_pairs(pages: DataFrame, url_col: str = "url", html_col: str | None = "html",
               redirects: DataFrame | None = None) -> DataFrame:
    """(_uf_from, _uf_to) addresses: a page and the target of its tags, the ends of a redirect."""
    url = F.col(url_col)
    pairs = pages.sparkSession.createDataFrame([], "_uf_from string, _uf_to string")
    if html_col:
        def value(tag: str, target: str) -> Column:
            return _unescape(F.regexp_extract(F.regexp_extract(html_col, tag, 0), target, 1))

        raw = (pages.filter(F.instr(url, "://") > 0)
               .select(url.alias("_uf_from"), value(*_BASE).alias("_uf_base"), value(*_CANONICAL).alias("c"),
                       value(*_REFRESH).alias("r")).filter("c != '' or r != ''"))
        base = F.coalesce(resolve(F.col("_uf_base"), F.col("_uf_from")), F.col("_uf_from"))
        pairs = pairs.unionByName(raw.select("_uf_from", F.explode(F.array_compact(F.array(
            resolve(F.col("c"), base), resolve(F.col("r"), base)))).alias("_uf_to")))
    if redirects is not None:
        pairs = pairs.unionByName(redirects.filter(F.instr("from_url", "://") > 0).select(
            F.col("from_url").alias("_uf_from"), resolve(F.col("to_url"), F.col("from_url")).alias("_uf_to")))
    return pairs.filter("_uf_from is not null and _uf_to is not null").distinct()


def _addresses(pages: DataFrame, pairs: DataFrame, url_col: str) -> DataFrame:
    """(url) the pages' addresses and both ends of ``pairs``, each once."""
    ends = pages.filter(F.instr(F.col(url_col), "://") > 0).select(F.col(url_col).alias("url"))
    for c in ("_uf_from", "_uf_to"):
        ends = ends.unionByName(pairs.select(F.col(c).alias("url")))
    return ends.distinct()


def alias_edges(pages: DataFrame, pairs: DataFrame, url_col: str = "url") -> DataFrame:
    """(a, b) edges between address nodes: ``pairs``, and every address to its canonical form."""
    forms = _addresses(pages, pairs, url_col).select(
        F.col("url").alias("_uf_from"), canonical_form(F.col("url")).alias("_uf_to")).filter("_uf_to != ''")
    linked = pairs.unionByName(forms).filter("_uf_from != _uf_to")
    return linked.select(_node(F.col("_uf_from")).alias("a"), _node(F.col("_uf_to")).alias("b"))


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] | DataFrame = RULES, url_col: str = "url",
                html_col: str | None = "html", redirects: DataFrame | None = None,
                judge_targets: bool = False) -> DataFrame:
    """``pages`` plus host, path, rule and verdict (the rule's, else that of the aliases)."""
    # an edge to an address that nothing else names joins no two pages; only shared ends matter
    pairs = write_once(link_pairs(pages, url_col, html_col, redirects), "alias-links")
    edges = write_once(alias_edges(pages, pairs, url_col).distinct(), "alias-edges")
    ends = edges.select(F.col("a").alias("n")).unionByName(edges.select(F.col("b").alias("n")))
    shared = ends.groupBy("n").agg(F.count(F.lit(1)).alias("_uf_k")).filter("_uf_k > 1").select("n")
    # keep an edge unless one of its ends has no other edge and is not a page of its own:
    # canonical forms are no page addresses, so such an edge is a leaf without a page
    real = edges.join(shared, F.col("b") == F.col("n"), "left_semi")
    touched = edges.join(shared, F.col("a") == F.col("n"), "left_semi")
    comps = connected_components(real.unionByName(touched))
    judged = match_rules(pages, rules, url_col)
    node = _node(F.col(url_col))
    ruled = judged.filter("rule is not null").select(node.alias("node"), "verdict")
    if judge_targets:
        ends = pairs.select(F.explode(F.array("_uf_from", "_uf_to")).alias("url"))
        ruled = ruled.unionByName(match_rules(ends, rules).filter("rule is not null")
                                  .select(_node(F.col("url")).alias("node"), "verdict"))
    explicit = (ruled.distinct()
                .join(comps, "node").groupBy("component")
                .agg(F.max((F.col("verdict") == "allow").cast("int")).alias("_uf_allow"),
                     F.max((F.col("verdict") == "block").cast("int")).alias("_uf_block")))
    blocked = write_once(
        comps.join(explicit.filter("_uf_block = 1 and _uf_allow = 0"), "component", "left_semi")
        .select(F.col("node").alias("_uf_node")), "blocked-aliases")
    out = judged.withColumn("_uf_page", F.when(F.col("rule").isNull(), node))
    if blocked.isEmpty():
        found = out.withColumn("_uf_hit", F.lit(False))
    else:
        found = (out.join(blocked.withColumn("_uf_hit", F.lit(True)),
                          F.col("_uf_page") == F.col("_uf_node"), "left").drop("_uf_node"))
    return (found.withColumn("verdict", F.coalesce(
        "verdict", F.when(F.coalesce("_uf_hit", F.lit(False)), "block").otherwise("allow")))
        .drop("_uf_hit", "_uf_page"))
