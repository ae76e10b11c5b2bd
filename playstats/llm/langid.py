"""Language ID by Bayesian fusion of text, declared language, address suffix, path label and host priors.

*Text.* Hashed byte trigrams (letters and word ends) are counted by declared language over all
documents; they give each language's multinomial likelihood, tempered to ``TEMPER`` trigrams so
that a long text does not drown all other evidence.
*Declared language* (markup attribute or table column), *address suffix* (last label of the host) and
*path label* (leading path segment): their distributions given the language come from grouped counts of
(evidence, best language by text), smoothed.
*Host priors.* Grouped counts of the best language by text at every level of the host name (a.b.c,
b.c, c) and over all; each level is smoothed with its parent: (n + K * parent) / (total + K).

*None of these.* One more outcome, with prior ``OUTSIDE``: uniform over the trigram bins, any suffix or path
label with its share of all rows, any declared label as if it had not been seen. A text that this outcome
explains best trains neither the evidence tables nor the host priors.

The posterior is the normalised product. The language is the best one, and a document is rejected if
its text has no letters or its language does not reach ``MIN_POSTERIOR``.

Languages are all declared labels, also those of a single document: its few counts, smoothed by half
a count a bin, stay close to the uniform distribution. They are counted and scored ``CLASSES`` at a
time, which bounds the tables of counts in the driver and the workers; the labels themselves, and one
number a language and row, are not bounded.

Defined results. A null, empty or letterless text is rejected with language ``und`` and
probability 0. Missing evidence of any other kind is left out. A declared label counts by its first run of
A-Z, the primary part of a language tag (``zh-TW`` as ``zh``); one without is no label. Without any declared
language every document is ``und``, and the filter keeps every row. Other columns of the input are not read, so their
names cannot clash; very long texts are read as a whole. Repeated rows are judged alike, each by its own text. An empty table
gives an empty result.

Scale. Two passes over the texts for each ``CLASSES`` languages; the first returns one count a language and trigram bin from
each task. The host table is joined to rows without text, broadcast only after its rows are counted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.llm.common import row_key, small_batches, small_join, write_once

BINS = 1 << 14
TEMPER = 60
CLASSES = 100       # languages a pass
OUTSIDE = 0.01
MIN_POSTERIOR = 0.5
SMOOTH = 20.0       # K of the host levels

# bytes that count as letters: A-Z folded to a-z, and everything beyond ASCII; all else is a word end
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_bins(text: str | None) -> np.ndarray:
    """The bins of the text's trigrams of letters and word ends (at most one word end each)."""
    b = _FOLD[np.frombuffer((" " + (text or "") + " ").encode("utf-8", "surrogatepass"), np.uint8)]
    gap = b == 32
    b = b[~(gap & np.append(False, gap[:-1]))].astype(np.uint32)      # one word end in a row
    if len(b) < 3:
        return np.empty(0, np.int64)
    key = b[:-2] * np.uint32(65536) + b[1:-1] * np.uint32(256) + b[2:]
    key = key[b[1:-1] != 32]
    return ((key * np.uint32(2654435761)) >> np.uint32(32 - int(math.log2(BINS)))).astype(np.int64)


def _bin_counts(texts: DataFrame, languages: list[str]) -> np.ndarray:
    """(languages x bins) trigram counts over all of ``texts`` (declared, text)."""
    number = {x: i for i, x in enumerate(languages)}

    def count(batches):
        total = np.zeros((len(languages), BINS), np.int64)
        for batch in small_batches(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[number[lang]] += np.bincount(trigram_bins(text), minlength=BINS)
        for i in range(len(languages)):
            used = np.nonzero(total[i])[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), i, np.int32)), pa.array(used.astype(np.int32)),
                                              pa.array(total[i][used])], ["l", "b", "n"])

    out = np.zeros((len(languages), BINS))
    for r in texts.mapInArrow(count, "l int, b int, n long").groupBy("l", "b").agg(F.sum("n").alias("n")).collect():
        out[r["l"], r["b"]] = r["n"]
    return out


def _text_evidence(rows: DataFrame, gain: np.ndarray, name: str, last: bool) -> DataFrame:
    """``rows`` plus ``letters`` (trigrams, if not there) and ``name``: tempered log likelihoods less
    that of no language; without ``text`` after the ``last`` pass."""
    at = rows.columns.index("text")
    keep = [f for f in rows.schema if not (last and f.name == "text")]
    count = "letters" not in rows.columns

    def score(batches):
        for batch in small_batches(batches, text=at):
            n, ll = [], []
            for text in batch.column(at).to_pylist():
                bins = trigram_bins(text)
                n.append(len(bins))
                ll.append(gain[:, bins].sum(axis=1) * (min(1.0, TEMPER / len(bins)) if len(bins) else 0.0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if not (last and i == at)),
                 *([pa.array(n, pa.int64())] if count else []), pa.array(ll, pa.list_(pa.float64()))],
                [*(f.name for f in keep), *(["letters"] if count else []), name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(score, f"{schema}{', letters long' if count else ''}, {name} array<double>")


def _add(a: Column, b: Column) -> Column:
    """Sum of two arrays; a null one adds nothing."""
    return F.when(b.isNull(), a).otherwise(F.zip_with(a, b, lambda x, y: x + y))


def _counts_of(size: int) -> Column:
    """The counts of the map ``m`` (by language) as an array."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                       lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0)).cast("double"))


def _given_language(rows: DataFrame, col: str, size: int) -> DataFrame:
    """(value, logs, other): log P(value | language) from grouped counts, smoothed by one, and
    log P(value | none of these)."""
    counts = rows.filter(F.col(col).isNotNull() & (F.col("letters") > 0) & F.col("best").isNotNull()) \
        .groupBy(col, "best").agg(F.count(F.lit(1)).alias("n"))
    total = {r["best"]: r["n"] for r in counts.groupBy("best").agg(F.sum("n").alias("n")).collect()}
    values = counts.agg(F.countDistinct(col).alias("v")).first()["v"]
    below = F.array(*[F.lit(total.get(i, 0) + values + 1.0) for i in range(size)])
    seen = F.lit(0.0) if col == "label" else F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x)
    by = counts.groupBy(col).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m"))
    return by.select(F.col(col).alias("value"),
                     F.zip_with(_counts_of(size), below, lambda n, t: F.log((n + 1.0) / t)).alias("logs"),
                     F.log((seen + 1.0) / F.lit(sum(total.values()) + values + 1.0)).alias("other"))


def _host_priors(rows: DataFrame, size: int) -> DataFrame:
    """(host, logs): log prior of each language for every full host name."""
    used = rows.filter((F.col("letters") > 0) & F.col("host").isNotNull() & F.col("best").isNotNull())
    by_host = used.groupBy("host", "best").agg(F.count(F.lit(1)).alias("n"))
    # every host counts for its own name and for each parent domain, down to the last label
    labels = F.split("host", r"\.")
    level = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        i.alias("depth"), F.array_join(F.slice(labels, F.size(labels) - i + 1, i), ".").alias("name"))))
    per = (by_host.select("best", "n", level.alias("l")).groupBy("l.name", "best").agg(F.sum("n").alias("n"))
           .groupBy("name").agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias("m")))
    vec = write_once(per.select("name", _counts_of(size).alias("c")), "langid-host-levels")
    every = by_host.groupBy("best").agg(F.sum("n").alias("n")).collect()
    root = np.full(size, 1.0)
    for r in every:
        root[r["best"]] += r["n"]
    prior = F.array(*[F.lit(float(x)) for x in root / root.sum()])
    hosts = by_host.select("host").distinct()
    chain = (hosts.select("host", level.alias("l")).select("host", "l.depth", "l.name")
             .join(vec, "name").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("depth", "c"))).alias("levels")))

    def smooth(parent: Column, item: Column) -> Column:
        n = F.aggregate(item["c"], F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(item["c"], parent, lambda x, p: (x + SMOOTH * p) / (n + SMOOTH))

    return chain.select("host", F.transform(F.aggregate("levels", prior, smooth), lambda x: F.log(x)).alias("logs"))


def _declared(declared_col: str) -> Column:
    """The primary part of a label (``zh`` of ``zh-TW``): its first run of A-Z; empty if there is none."""
    return F.lower(F.regexp_extract(F.col(declared_col), r"^\s*([A-Za-z]+)", 1))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared_col: str | None = "lang",
                       host_col: str | None = "source", suffix_col: str | None = None,
                       min_posterior: float = MIN_POSTERIOR, path_col: str | None = None) -> DataFrame:
    """(doc_id, row_md5, declared, language, probability, accepted) of every row.

    ``row_md5`` is the MD5 of the text (null for a null one), which tells rows with one id apart.
    """
    none = F.lit(None).cast("string")
    label = _declared(declared_col) if declared_col else none
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.md5(text_col).alias("row_md5"),
        F.nullif(label, F.lit("")).alias("declared"),
        (F.lower(F.col(host_col).cast("string")) if host_col else none).alias("host"),
        (F.lower(F.col(suffix_col).cast("string")) if suffix_col else none).alias("suffix"),
        (F.lower(F.col(path_col).cast("string")) if path_col else none).alias("path"))
    held = base.filter("declared is not null").select("declared").distinct()
    languages = sorted(r["declared"] for r in held.collect())
    if not languages:
        return base.select("doc_id", "row_md5", "declared", F.lit("und").alias("language"),
                           F.lit(0.0).alias("probability"), F.lit(False).alias("accepted"))
    size = len(languages)
    rows, parts = base, []
    for at in range(0, size, CLASSES):
        part = languages[at:at + CLASSES]
        counts = _bin_counts(base.filter(F.col("declared").isin(part)).select("declared", "text"), part) + 0.5
        gain = np.log(counts / counts.sum(axis=1, keepdims=True)) + math.log(BINS)
        parts.append(f"ll{at}")
        rows = write_once(_text_evidence(rows, gain, parts[-1], at + CLASSES >= size), "langid-evidence")
    rows = rows.withColumn("ll", F.concat(*parts)).drop(*parts)
    rows = rows.withColumn("best", F.when(F.array_max("ll") > 0, F.array_position("ll", F.array_max("ll")).cast("int") - 1)) \
        .withColumn("label", F.col("declared"))
    fused = rows
    score, other = F.col("ll"), F.lit(math.log(OUTSIDE))
    given = {"label": declared_col, "suffix": suffix_col, "path": path_col, "host": host_col}
    for col in (kind for kind, source in given.items() if source):
        logs = _host_priors(rows, size) if col == "host" else _given_language(rows, col, size)
        if "other" not in logs.columns:
            logs = logs.withColumn("other", F.lit(0.0))
        logs = write_once(logs.select(F.col(logs.columns[0]).alias(f"_{col}"), F.col("logs").alias(f"{col}_logs"),
                                      F.col("other").alias(f"{col}_other")), f"langid-{col}")
        n = logs.count()
        if n:
            fused = small_join(fused, logs, F.col(col) == F.col(f"_{col}"), "left", rows=n)
            score = _add(score, F.col(f"{col}_logs"))
            other = other + F.coalesce(F.col(f"{col}_other"), F.lit(0.0))
    fused = fused.withColumn("s", score).withColumn("o", other).withColumn("top", F.array_max("s"))
    names = F.array(*[F.lit(x) for x in languages])
    probability = 1.0 / F.aggregate("s", F.exp(F.col("o") - F.col("top")), lambda a, x: a + F.exp(x - F.col("top")))
    seen = F.col("letters") > 0
    return fused.select(
        "doc_id", "row_md5", "declared",
        F.when(seen, F.element_at(names, F.array_position("s", F.col("top")).cast("int"))).otherwise("und").alias("language"),
        F.when(seen, probability).otherwise(0.0).alias("probability"),
        (seen & (probability >= min_posterior)).alias("accepted"))


def keep_identified(docs: DataFrame, declared_col: str | None = "lang", **options) -> DataFrame:
    """``docs`` without the rows that language ID rejects.

    A row is told from others by all its columns, so rows with one id and one text but another label or
    host are judged each by itself. If no row declares a language there is nothing to judge by, and
    every row stays.
    """
    columns = [*docs.columns]
    if declared_col is None or not docs.filter(_declared(declared_col) != "").limit(1).count():
        return docs
    keyed = docs.withColumn("_li_key", row_key(columns))
    judged = identify_languages(keyed, id_col="_li_key", declared_col=declared_col, **options)
    out = write_once(judged.filter(~F.col("accepted")).select("doc_id").distinct(), "langid-rejected")
    return small_join(keyed, out.withColumnRenamed("doc_id", "_li_key"), "_li_key", "left_anti").select(*[f"`{c}`" for c in columns])
