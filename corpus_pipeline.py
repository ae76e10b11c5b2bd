"""The training-data pipeline: five stages over ``documents``, each one of the operators.

Each stage gets its predecessor's rows (``docs``) as a whole and returns a DataFrame, which is
written as Parquet and read again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.llm.common import row_key, write_once
from playstats.llm.langid import keep_identified
from playstats.llm.line_dedup import line_dedup
from playstats.llm.mixing import mix_sources, take
from playstats.llm.neardup import near_duplicates
from playstats.llm.packing import pack_documents
from playstats.session import ensure_checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; without any declared language all of them."""
    return keep_identified(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that at least five documents share; n_chars follows the text."""
    return line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, similarity 0.8): the one with the
    smallest ``doc_id``, null last, among equal ids the one with the smallest row key. Of rows that are equal in
    all columns one stays; all others are told apart by 128 bits of all columns, so rows with a null
    or repeated ``doc_id`` stay if their texts differ. The groups are found on numbers given to the stored rows."""
    columns = [f"`{c}`" for c in docs.columns]
    single = docs.withColumn("_nd_row", row_key(docs.columns)).dropDuplicates(["_nd_row"])
    single = write_once(single.withColumn("_nd_key", F.monotonically_increasing_id()), "neardup-rows")
    found = near_duplicates(single, id_col="_nd_key").select(F.col("doc_id").alias("_nd_key"), "component_id")
    ids = single.select("_nd_key", "_nd_row", F.col("doc_id").alias("_nd_id"))
    order = F.struct(F.col("_nd_id").isNull().alias("none"), "_nd_id", "_nd_row", "_nd_key")
    kept = found.join(ids, "_nd_key").groupBy("component_id").agg(F.min(order).alias("k")).select("k._nd_key")
    return single.join(write_once(kept, "neardup-kept"), "_nd_key", "left_semi").select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it."""
    return take(mix_sources(docs), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of 2048 tokens."""
    return pack_documents(docs, capacity=2048)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup),
          ("mix", mix), ("pack", pack)]

# token ids and signatures are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{root}/{i}-{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
