"""Structured Streaming ingestion of daily play-export drops (ST1) and a running
monthly aggregate over the ingested plays (ST2).

ST1: a CSV file source over the drop folder; each micro-batch runs the same ingest
operators as the batch loader and appends to the same model tables, with the same writer
(plays partitioned by play year), so a stream goes on where a batch load ended:

* new artist names / (title, artist) pairs get ids after the current maximum
  (one-row aggregate, broadcast) in natural-key order;
* plays of the batch and the stored plays of its range of days are grouped together by
  (track_id, played_at): the smallest row of each side. A day that is not stored is
  appended; a replayed batch (after a failure) or a re-sent equal row appends nothing.

A day may be split over drops or sent again with other values: the smallest row of a day stands, as in
the batch loader, whatever the order of the drops. A smaller row than the stored one is appended as a
correction: the new row (``change`` 1) and the stored one taken back (``change`` -1), both in the same
write. Readers merge the versions (``ingest.merge_versions``); sums over the changes need no merging.

No watermark is needed: the key is a calendar day and every day stays open; a late
file is simply another batch of days.

ST2: a Parquet file source over the plays table written by ST1, grouped by month in
complete output mode (the state is one row per month).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.functions.exprs import month_name_padded, month_start, ntz_literal, year_month
from playstats.operators import ingest as IG
from playstats.session import cut_lineage
from playstats.sources.readers import PLAY_EXPORT_COLUMNS

PLAYS_SCHEMA = T.StructType([
    T.StructField("track_id", T.LongType()),
    T.StructField("played_at", T.TimestampNTZType()),
    T.StructField("play_duration_ms", T.LongType()),
    T.StructField("play_count", T.IntegerType()),
    T.StructField("skip_count", T.IntegerType()),
    T.StructField("change", T.ByteType()),             # -1: takes a stored row back; 1 or null: a row
    T.StructField("play_year", T.IntegerType()),       # the partition
])


PLAYS_DDL = ("track_id long, played_at timestamp_ntz, play_duration_ms long, play_count int, "
             "skip_count int, change tinyint, play_year int")
PLAY_ROW = "struct<play_duration_ms: long, play_count: int, skip_count: int>"


def _export_schema(columns=None) -> T.StructType:
    cols = columns or list(PLAY_EXPORT_COLUMNS)
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _read_or_empty(spark: SparkSession, path: str, schema: str, declared: bool = False) -> DataFrame:
    """The table at ``path``; ``declared`` reads it with ``schema``, columns a file lacks being null."""
    if _exists(spark, path):
        return (spark.read.schema(schema) if declared else spark.read).parquet(path)
    # an empty relation that the optimiser knows to be empty (no join with it is run)
    return spark.range(0).select(*[F.lit(None).cast(t).alias(c) for c, t in map(str.split, schema.split(", "))]).filter(F.lit(False))


def _with_new_ids(new: DataFrame, existing: DataFrame, key_cols, id_col: str) -> DataFrame:
    """Number ``new`` keys after the current maximum id (ids never reused)."""
    offset = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("long").alias("_off"))
    numbered = IG.dim_with_surrogate_key(new, key_cols, "_local")
    return (numbered.crossJoin(F.broadcast(offset))
            .select((F.col("_off") + F.col("_local")).alias(id_col), *key_cols))


def merge_play_batch(batch: DataFrame, tables_root: str) -> None:
    """Merge one batch of raw export rows into artists / tracks / plays (idempotent)."""
    spark = batch.sparkSession
    root = tables_root.rstrip("/")
    raw = batch.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in PLAY_EXPORT_COLUMNS.items()])
    keyed = cut_lineage(IG.keyed_export(IG.prepare_play_export(raw)))     # the drop's files are read once
    named = cut_lineage(keyed.select("artist_name", "track_name").distinct())
    artists = _read_or_empty(spark, f"{root}/artists", "artist_id long, name string")
    new_names = (named.select(F.col("artist_name").alias("name")).dropna().distinct()
                 .join(artists.select("name"), "name", "left_anti"))
    IG.write_tables({"artists": _with_new_ids(new_names, artists, ["name"], "artist_id")}, root, "append")
    artists = spark.read.parquet(f"{root}/artists")

    tracks = _read_or_empty(spark, f"{root}/tracks", "track_id long, title string, artist_id long")
    pairs = (named.filter(F.col("track_name").isNotNull())
             .select(F.col("track_name").alias("title"), "artist_name")
             .join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_name")
             .select("title", "artist_id")
             .join(tracks.select("title", "artist_id"), ["title", "artist_id"], "left_anti"))
    new_tracks = _with_new_ids(pairs, tracks, ["artist_id", "title"], "track_id")
    IG.write_tables({"tracks": new_tracks.select("track_id", "title", "artist_id")}, root, "append")
    tracks = spark.read.parquet(f"{root}/tracks")

    stored = _read_or_empty(spark, f"{root}/plays", PLAYS_DDL, declared=True)
    # Only stored days inside this batch's range can collide: the range (one row) becomes
    # literal filters, on the year folders and on the day column, so a batch does not re-read
    # the whole history. Unparsable days (NULL) are one key per track.
    lo, hi = keyed.filter(F.col("pair").isNotNull()).agg(F.min("played_at"), F.max("played_at")).first()
    near = F.col("play_year").isNull()
    if lo is not None:
        near = near | (F.col("play_year").between(lo.year, hi.year) & F.col("played_at").between(ntz_literal(lo), ntz_literal(hi)))
    # Both sides meet in one grouping, one row per track and day: the smallest row of the batch and the
    # smallest of the stored versions, which is the one that stands (as in merge_versions).
    values = list(IG.PLAY_VALUES)
    row = F.struct(*values)
    none = F.lit(None).cast(PLAY_ROW)
    sent = IG.resolve_plays(keyed, tracks, artists).select("track_id", "played_at", row.alias("_new"), none.alias("_old"))
    have = (stored.filter(near).filter(F.coalesce("change", F.lit(1)) == 1)
            .select("track_id", "played_at", none.alias("_new"), row.alias("_old")))
    both = sent.unionByName(have).groupBy("track_id", "played_at").agg(F.min("_new").alias("_new"), F.min("_old").alias("_old"))
    add = F.struct("_new.*", F.lit(1).cast("tinyint").alias("change"))
    back = F.struct("_old.*", F.lit(-1).cast("tinyint").alias("change"))
    versions = (F.when(F.col("_new").isNotNull() & F.col("_old").isNull(), F.array(add))
                .when(F.col("_new") < F.col("_old"), F.array(add, back)))
    # adaptive execution sizes the files: one per year and advisory partition size
    fresh = (both.select("track_id", "played_at", F.inline(versions))
             .withColumn("play_year", F.year("played_at")).hint("rebalance", "play_year"))
    IG.write_tables({"plays": fresh}, root, "append")


def ingest_plays_stream(spark: SparkSession, source_dir: str, tables_root: str,
                        checkpoint_location: str, columns=None, available_now: bool = True,
                        files_per_batch: int | None = None):
    """ST1: start the ingest stream; returns the StreamingQuery.

    ``columns`` lists the export's columns in file order (names are validated
    against the header); the default is the five columns the loader reads.
    """
    reader = spark.readStream.schema(_export_schema(columns)).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.csv(source_dir)
    w = (stream.writeStream.foreachBatch(lambda df, epoch: merge_play_batch(df, tables_root))
         .option("checkpointLocation", checkpoint_location))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def monthly_plays_stream(spark: SparkSession, plays_dir: str, checkpoint_location: str,
                         query_name: str | None = "monthly_plays", sink: str = "memory",
                         out_dir: str | None = None):
    """ST2: running plays per month over the ingested plays table (complete mode).

    ``sink="parquet"`` replaces the table in ``out_dir`` after each micro-batch; the memory
    sink keeps it on the driver (one row per month).
    """
    plays = spark.readStream.schema(PLAYS_SCHEMA).parquet(plays_dir)
    monthly = (plays.groupBy(month_start("played_at").alias("month"))
               .agg(F.sum(F.col("play_count") * F.coalesce("change", F.lit(1))).alias("plays"))
               .select("plays", month_name_padded("month").alias("month_name"),
                       year_month("month").alias("year_month")))
    w = monthly.writeStream.outputMode("complete")
    if query_name:
        w = w.queryName(query_name)
    if sink == "parquet":
        w = w.foreachBatch(lambda df, _: df.coalesce(1).write.mode("overwrite").parquet(out_dir))  # a row a month
    else:
        w = w.format(sink)
    return w.option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()


def replay_as_drops(raw: DataFrame, work_dir: str, files: int = 24) -> str:
    """Write raw export rows as about ``files`` CSV drop files; returns the drop folder.

    Rows are dealt by hash of all their columns, so the rows of a day are spread over the drops and a
    day with very many rows is no large task.
    """
    drops = f"{work_dir.rstrip('/')}/drops"
    columns = [F.col(f"`{c}`") for c in PLAY_EXPORT_COLUMNS]
    raw.repartition(files, *columns).select(*columns).write.mode("overwrite").option("header", True).csv(drops)
    return drops


def stream_monthly_from_export(spark: SparkSession, raw: DataFrame, work_dir: str,
                               files_per_batch: int = 16) -> DataFrame:
    """End to end: drops -> ST1 (``files_per_batch`` files a micro-batch) -> ST2 -> monthly table."""
    root = work_dir.rstrip("/")
    drops = replay_as_drops(raw, root)
    ingest_plays_stream(spark, drops, f"{root}/tables", f"{root}/ck/ingest",
                        files_per_batch=files_per_batch).awaitTermination()
    monthly_plays_stream(spark, f"{root}/tables/plays", f"{root}/ck/monthly", query_name=None, sink="parquet",
                         out_dir=f"{root}/monthly").awaitTermination()
    return spark.read.parquet(f"{root}/monthly")
