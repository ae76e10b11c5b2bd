"""The registered queries of the operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm import oracle as _oracle
from playstats.llm.ann import nearest_neighbours
from playstats.llm.common import read
from playstats.llm.infill import fill_in_middle, restored
from playstats.llm.langid import identify_languages
from playstats.llm.line_dedup import line_dedup
from playstats.llm.mixing import mix_sources
from playstats.llm.neardup import near_duplicates
from playstats.llm.packing import pack_documents
from playstats.llm.page_language import page_languages
from playstats.llm.quality import score_quality
from playstats.llm.sharding import shard_documents
from playstats.llm.topk import exact_top_k
from playstats.llm.toxicity import score_toxicity
from playstats.llm.urlfilter import filter_urls
from playstats.llm.whitening import whiten


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped",
                                   F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), shards=8)


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read(spark, sf_dir, "embeddings"), k=10, every=100)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"), capacity=2048)


def op5_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read(spark, sf_dir, "documents")).drop("row_md5")


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(read(spark, sf_dir, "pages"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), judge_targets=True).select("page_id", "host", "path", "rule", "verdict")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = restored(fill_in_middle(read(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"), components=8)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_line_dedup, op2_kd_sharding, op3_exact_top_k, op4_best_fit_packing, op5_multi_index_hashing,
    op6_source_mix, op7_minhash_near_dedup, op8_quality, op9_language_id, page_language_id, op10_url_filter,
    op11_fill_in_middle, op12_embedding_whitening, op13_toxicity)}
ORACLE: dict[str, str] = _oracle.ORACLE
