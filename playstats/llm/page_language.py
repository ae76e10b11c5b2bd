"""Evidence of a web page's language, and the language of every page (operator 9 over ``pages``).

*Declared markup language*: ``lang`` (or ``xml:lang``) of the first ``<html>`` tag, else the first
``<meta http-equiv="content-language">``. *Address suffix*: the last label of the host (``fr`` of ``a.b.fr``),
none for numeric addresses. *Path label*: a leading path segment that looks like a language tag (two or three letters,
with or without a region); what such a segment says is left to the counts. *Host*: its whole name, for the smoothed
priors. *Text*: the page without comments, scripts, styles and tags, character references replaced.

:func:`playstats.llm.langid.identify_languages` weighs them; a page may lack any of them.

Defined results. A null or empty page has no text and is ``und``; an address that is null or has no ``://`` gives no
host, suffix or path label. An unclosed comment, script, style or tag reaches to the end of the page. Pages are read as
wholes, in time linear in their length. Repeated rows are judged alike. Other columns are not read, so their names
cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from playstats.llm.common import small_batches
from playstats.llm.langid import identify_languages
from playstats.llm.urlfilter import host_of, path_of
from playstats.session import configure

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[/!?a-z][^>]*(?:>|\Z)", re.I | re.S)
_LANG = r"(?is)(?<![\w-])lang\s*=\s*[\"']?([^\"'\s>]+)"
_CONTENT = r"(?is)(?<![\w-])content\s*=\s*[\"']?([^\"'\s>]+)"
_META = r"(?is)<meta\s[^>]*?http-equiv\s*=\s*[\"']?content-language[\"']?[^>]*>"


def visible_text(page: str | None) -> str | None:
    return html.unescape(_MARKUP.sub(" ", page)) if isinstance(page, str) else None


@F.arrow_udf(StringType())
def _visible(pages: pa.Array) -> pa.Array:
    """A slice of a few MB at a time becomes Python texts."""
    batch = pa.RecordBatch.from_arrays([pages], ["page"])
    parts = [pa.array([visible_text(p) for p in b.column(0).to_pylist()], pa.string()) for b in small_batches([batch], text=0)]
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def declared_language(page: Column) -> Column:
    """What the markup says, as it stands; null if it says nothing."""
    tag = F.regexp_extract(page, r"(?is)<html\b[^>]*>", 0)
    return F.coalesce(_some(F.regexp_extract(tag, _LANG, 1)), _some(F.regexp_extract(F.regexp_extract(page, _META, 0), _CONTENT, 1)))


def page_evidence(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, text, declared, host, suffix, path) of every page."""
    url, page = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    host = _some(F.regexp_replace(host_of(url), r"^.*@|\.?(:[0-9]*)?$", ""))
    return pages.select(
        F.col(id_col).alias("page_id"), _visible(page).alias("text"), declared_language(page).alias("declared"), host.alias("host"),
        _some(F.regexp_extract(host, r"\.([^.0-9\]][^.]*)$", 1)).alias("suffix"),
        _some(F.lower(F.regexp_extract(path_of(url), r"^/([A-Za-z]{2,3}([-_][A-Za-z]{2,4})?)(/|$)", 1))).alias("path"))


def page_languages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **options) -> DataFrame:
    """(page_id, declared, language, probability, accepted) of every page, by text, markup, address and host."""
    configure(pages.sparkSession)      # pages are long: batches bounded by bytes
    columns = {"declared_col": "declared", "host_col": "host", "suffix_col": "suffix", "path_col": "path"} | options
    judged = identify_languages(page_evidence(pages, id_col, url_col, html_col), id_col="page_id", **columns)
    return judged.withColumnRenamed("doc_id", "page_id").drop("row_md5")
