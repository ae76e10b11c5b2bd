"""Raw inputs in the shape of the real sources, derived from the driver tables.

The loaders and the enrichment are exercised end to end on these frames exactly
as they would run on CSV / JSON files read by :mod:`playstats.sources.readers`:

* ``raw_play_export``   one export row per line item (all of them): description
  "<supplier name> - <part name>", day as yyyyMMdd text, duration, counts. A few
  rows (return flag A on line 7) lack a description and some (open status on line
  6) lack the separator, so the null and no-separator paths carry data.
* ``raw_song_catalog``  one catalog row per part, artist = the fixture artist of the
  part, release dates of mixed precision plus junk, both genre columns.
* ``landed_lookups``    one lookup response per artist: no hits for negative balances,
  no tags below 1000, no country for some nations, a truncated body (a failed fetch, to
  be tried again) for every fiftieth id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.sources.fixtures import play_count, play_day, table


def _n_sup(spark, sf_dir):
    return F.broadcast(table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("_n_sup")))


def _compact_day():
    """The day of a play as yyyyMMdd text."""
    day = play_day()
    number = F.year(day) * 10000 + F.month(day) * 100 + F.day(day)
    return (F.when(F.year(day).between(0, 9999), F.lpad(number.cast("string"), 8, "0"))
            .otherwise(F.translate(day.cast("string"), "-", "")))


def raw_play_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = (li.join(p, li.l_partkey == p.p_partkey).crossJoin(_n_sup(spark, sf_dir))
            .join(s, (F.col("l_partkey") % F.col("_n_sup")) == F.col("s_suppkey")))
    desc = (F.when((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7), F.lit(None))
            .when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 6), F.col("s_name"))
            .otherwise(F.concat(F.col("s_name"), F.lit(" - "), F.col("p_name"))))
    return rows.select(
        desc.cast("string").alias("Track Description"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 5), F.lit("unknown"))
        .otherwise(_compact_day()).alias("Date Played"),
        F.rint(F.col("l_extendedprice") * 3).cast("long").alias("Play Duration Milliseconds"),
        play_count().alias("Play Count"),
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int") % 4)
        .otherwise(F.lit(0)).cast("int").alias("Skip Count"))


def raw_song_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    rows = (p.crossJoin(_n_sup(spark, sf_dir))
            .join(s, (F.col("p_partkey") % F.col("_n_sup")) == F.col("s_suppkey")))
    k, size = F.col("p_partkey"), F.col("p_size")
    year = (1960 + size).cast("string")
    month = F.concat(F.lit("-0"), (1 + size % 9).cast("string"))
    day = F.concat(F.lit("-1"), (size % 10).cast("string"))
    release = (F.when(size % 10 == 0, F.lit("unknown"))
               .when(size % 3 == 0, year)
               .when(size % 3 == 1, F.concat(year, month))
               .otherwise(F.concat(year, month, day)))
    return rows.select(
        F.col("p_name").alias("track_name"),
        F.col("s_name").alias("track_artist"),
        F.when(k % 50 != 13, F.col("p_brand")).alias("track_album_name"),
        release.alias("track_album_release_date"),
        F.round(F.col("p_retailprice") * 200).cast("int").alias("duration_ms"),
        F.col("p_type").alias("playlist_genre"),
        F.col("p_brand").alias("playlist_subgenre"),
        (size / 50.0).cast("double").alias("danceability"),
        ((k * 37 % 101) / 100.0).cast("double").alias("energy"),
        ((k * 11 % 101) / 100.0).cast("double").alias("speechiness"),
        ((k * 71 % 101) / 100.0).cast("double").alias("acousticness"),
        ((k * 53 % 101) / 100.0).cast("double").alias("valence"),
        (60 + size * 2.5).cast("double").alias("tempo"))


def landed_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    tag = lambda c: F.struct(F.lower(c).alias("name"))
    hit = F.struct(
        F.concat(F.lit("mb-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.when(F.col("s_nationkey") % 5 != 0, F.col("n_name")).alias("country"),
        F.when(F.col("s_acctbal") >= 1000,
               F.array(tag(F.col("r_name")), tag(F.col("n_name")), tag(F.col("r_name"))))
        .alias("tags"))
    body = (F.when(F.col("s_suppkey") % 50 == 1, F.lit('{"artists": ['))
            .when(F.col("s_acctbal") < 0, F.lit('{"artists": []}'))
            .otherwise(F.to_json(F.struct(F.array(hit).alias("artists")))))
    return j.select(F.col("s_suppkey").cast("long").alias("artist_id"), body.alias("body"))
