"""Readers for the raw inputs: daily play export, song catalog, landed lookups.

CSV files are read with every column as string and then selected **by name** and
cast, so extra or reordered export columns do not matter, also between the files of one
folder: files are grouped by their header line and each group is read with its own header.
No schema inference (that would need an extra pass over the files).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the two CSV sources, as exported.
PLAY_EXPORT_COLUMNS = {
    "Track Description": "string",
    "Date Played": "string",
    "Play Duration Milliseconds": "long",
    "Play Count": "int",
    "Skip Count": "int",
}
CATALOG_COLUMNS = {
    "track_name": "string", "track_artist": "string", "track_album_name": "string",
    "track_album_release_date": "string", "duration_ms": "int",
    "playlist_genre": "string", "playlist_subgenre": "string",
    "danceability": "double", "energy": "double", "speechiness": "double",
    "acousticness": "double", "valence": "double", "tempo": "double",
}

LOOKUP_LANDED_SCHEMA = T.StructType([
    T.StructField("artist_id", T.LongType()),
    T.StructField("body", T.StringType()),
])


def _select_cast(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    # try_cast: a malformed number becomes NULL (counted by the null checks) instead
    # of failing the whole load.
    return df.select(*[F.col(f"`{c}`").try_cast(t).alias(c) for c, t in columns.items()])


HEADER_THREADS = 32   # header lines read at a time


def _files(spark: SparkSession, path: str) -> list[str]:
    """The files that Spark reads below ``path``, without empty ones (names and lengths only; nothing is opened)."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return [r["path"] for r in listed.filter("length > 0").select("path").collect()]


def _header(spark: SparkSession, file: str) -> str:
    """The first line of a file that is not blank (one short read, nothing more of it)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(file)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
        spark.sparkContext._jsc.hadoopConfiguration()).getCodec(p)
    try:
        text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
        lines = jvm.java.io.BufferedReader(text)
        line = lines.readLine()
        while line is not None and not line.lstrip("\ufeff").strip():
            line = lines.readLine()
        return (line or "").lstrip("\ufeff")
    finally:
        stream.close()


def _read_csv(spark: SparkSession, path: str, columns: dict[str, str], **options) -> DataFrame:
    """CSV files of one path, selected by name; files with different headers are read apart.

    Of every file, however many there are, the header line is read first (``HEADER_THREADS`` at a
    time). Where all agree the path is read as a whole, else the files of each header by themselves; Spark
    compares each file with the header (``enforceSchema=False``). Files without a line are passed over.
    """
    reader = lambda: (spark.read.option("header", True).option("inferSchema", False)
                      .option("recursiveFileLookup", True).option("enforceSchema", False).options(**options))
    files = _files(spark, path)
    by_header: dict[str, list[str]] = {}
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        for file, header in zip(files, pool.map(lambda f: _header(spark, f), files)):
            by_header.setdefault(header, []).append(file)
    if len(by_header) == 1 and "" not in by_header:
        return _select_cast(reader().csv(path), columns)
    by_header.pop("", None)
    if not by_header:
        return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in columns.items()))
    parts = [_select_cast(reader().csv(fs), columns) for _, fs in sorted(by_header.items())]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_play_history(spark: SparkSession, path: str) -> DataFrame:
    """The daily play export (CSV with header)."""
    return _read_csv(spark, path, PLAY_EXPORT_COLUMNS)


def read_song_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The song catalog (CSV with header).

    ``multi_line`` allows line breaks inside quoted fields; each file is then read by one
    task, so a large catalog with such fields should arrive as many files, or as Parquet.
    """
    return _read_csv(spark, path, CATALOG_COLUMNS, escape='"', multiLine=multi_line)


def read_lookup_responses(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed lookup responses: one record (artist_id, body) per artist."""
    return spark.read.schema(LOOKUP_LANDED_SCHEMA).format(fmt).load(path)


MODEL_TABLE_NAMES = ("artists", "tracks", "plays", "genres", "artist_genres", "audio_features")


def read_model(spark: SparkSession, root: str, fmt: str = "parquet"):
    """The model tables written by :func:`playstats.operators.ingest.write_tables`.

    Missing tables (e.g. a play-history-only load has no audio features) are None.
    ``plays`` keeps its ``play_year`` partition column so year filters prune. If a stream has appended
    corrections of stored days, their versions are merged on read; the test for one reads the footers only.
    """
    from playstats.model import Model
    from playstats.operators.ingest import merge_versions
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tables = {}
    for name in MODEL_TABLE_NAMES:
        path = f"{root.rstrip('/')}/{name}"
        p = jvm.org.apache.hadoop.fs.Path(path)
        tables[name] = spark.read.format(fmt).load(path) if p.getFileSystem(conf).exists(p) else None
    plays = tables["plays"]
    if plays is not None and fmt == "parquet" and "play_year" in plays.columns:
        fields = [f for f in plays.schema if f.name not in ("change", "play_year")]
        versioned = T.StructType([*fields, T.StructField("change", T.ByteType()), plays.schema["play_year"]])
        versions = spark.read.schema(versioned).parquet(f"{root.rstrip('/')}/plays")
        corrected = versions.filter(F.col("change") == -1).limit(1).count()
        tables["plays"] = merge_versions(versions) if corrected else versions.drop("change")
    return Model(**tables)
