"""The report queries (R1-R39), one function per reference statement.

Conventions
-----------
* Every function takes a :class:`Model` and parameters and returns a lazy DataFrame
  whose columns follow the reference's names (SURVEY Appendix A).
* Counts, sums of counts and ranks are ``long``; rounded ratios are ``double``.
* LIMIT and ROW_NUMBER get a unique trailing tie-break so results are deterministic.
* Play-based reports aggregate plays per track (or per artist) **before** joining the
  dimensions and the artist-genre bridge: the fan-out join then sees one row per
  track/artist instead of one per play, and the first aggregation has a map-side
  partial step, so hot tracks/artists are reduced before any shuffle.
* Small dimensions (genres, artists) are left to Spark's size-checked automatic
  broadcast (``autoBroadcastJoinThreshold`` plus AQE runtime statistics); no
  unconditional broadcast hints on data that grows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playstats.functions.exprs import (int_div, month_name_padded, month_start, ntz_literal,
                                       num_round, year_month)
from playstats.model import Model
from playstats.operators.ranking import (global_rank, grouped_rank, grouped_ranks,
                                         grouped_row_number)
from playstats.session import cut_lineage

AUDIO = ("danceability", "energy", "tempo", "valence", "acousticness", "speechiness")


# -------------------------------------------------------------------- helpers
def track_artist(m: Model, *more: str) -> DataFrame:
    """tracks ⋈ artists: (track_id, title, artist_id, name) and ``more`` track columns."""
    return m.tracks.select("track_id", "title", "artist_id", *more).join(
        m.artists.select("artist_id", "name"), "artist_id")


def genre_bridge(m: Model, clean: bool = False) -> DataFrame:
    """artist_genres ⋈ genres (optionally clean_genres) ⋈ artists: (artist_id, genre)."""
    g = clean_genres(m) if clean else m.genres
    return (m.artist_genres.join(g.select("genre_id", F.col("name").alias("genre")), "genre_id")
            .join(m.artists.select("artist_id"), "artist_id")
            .select("artist_id", "genre"))


def plays_by_track(m: Model, *extra_keys) -> DataFrame:
    """Per-track (and optional period key) sums of plays, skips and duration."""
    p = m.plays
    keys = ["track_id", *extra_keys]
    return p.groupBy(*keys).agg(F.sum("play_count").alias("plays"),
                                F.sum("skip_count").alias("skips"))


def _plays_by_artist(m: Model, *extra_keys) -> DataFrame:
    per_track = plays_by_track(m, *extra_keys)
    t = m.tracks.select("track_id", "artist_id")
    return (per_track.join(t, "track_id")
            .groupBy("artist_id", *extra_keys)
            .agg(F.sum("plays").alias("plays"), F.sum("skips").alias("skips")))


def _features_by_artist(m: Model, cols) -> DataFrame:
    """Per-artist sums and counts of audio features over tracks ⋈ audio_features."""
    tf = m.tracks.select("track_id", "artist_id").join(m.audio_features, "track_id")
    aggs = []
    for c in cols:
        aggs += [F.sum(c).alias(f"s_{c}"), F.count(c).alias(f"n_{c}")]
    return tf.groupBy("artist_id").agg(*aggs)


def _genre_feature_avgs(m: Model, cols) -> DataFrame:
    per_artist = _features_by_artist(m, cols)
    agg = (genre_bridge(m).join(per_artist, "artist_id").groupBy("genre")
           .agg(*[(F.sum(f"s_{c}") / F.sum(f"n_{c}")).alias(f"_avg_{c}") for c in cols]))
    return agg.select("genre", *[num_round(f"_avg_{c}", 2).alias(f"avg_{c}") for c in cols])


def _desc(c: str):
    return F.col(c).desc_nulls_first()


# --------------------------------------------------- audio feature aggregates
def audio_profile_by_genre(m: Model) -> DataFrame:
    """Average audio features per genre (round 2), by danceability."""
    return _genre_feature_avgs(m, AUDIO).orderBy(_desc("avg_danceability"), "genre")


def genre_high_valence(m: Model, genre: str = "pop", min_valence: float = 0.95,
                       n: int = 25) -> DataFrame:
    """R2: tracks of one genre with valence above a bound, top n by valence."""
    bridge = genre_bridge(m).filter(F.col("genre") == genre)
    f = m.audio_features.filter(F.col("valence") > min_valence).select("track_id", "valence")
    return (track_artist(m).join(f, "track_id").join(bridge, "artist_id")
            .orderBy(_desc("valence"), "track_id").limit(n)
            .select("title", F.col("name").alias("artist"), "valence", "genre"))


def tracks_per_artist(m: Model) -> DataFrame:
    """Number of tracks per artist name."""
    per_artist = m.tracks.groupBy("artist_id").agg(F.count("track_id").alias("n"))
    return (per_artist.join(m.artists.select("artist_id", "name"), "artist_id")
            .groupBy(F.col("name").alias("artist")).agg(F.sum("n").cast("long").alias("track_count"))
            .orderBy(_desc("track_count"), "artist"))


def avg_valence_per_artist(m: Model, as_written: bool = False) -> DataFrame:
    """Average valence per artist (round 2).

    ``as_written=True`` keeps the reference's join of artist_id to track_id (D2).
    """
    t = m.tracks.select("track_id", "artist_id")
    a = m.artists.select("artist_id", "name")
    if as_written:
        joined = a.join(t.select(F.col("track_id")), a.artist_id == t.track_id).drop("artist_id")
    else:
        joined = a.join(t, "artist_id")
    j = joined.join(m.audio_features.select("track_id", "valence"), "track_id")
    return (j.groupBy(F.col("name").alias("artist"))
            .agg(num_round(F.avg("valence"), 2).alias("avg_valence"))
            .orderBy(_desc("avg_valence"), "artist"))


# -------------------------------------------------------- catalog exploration
def top_artists_by_track_count(m: Model, n: int = 20) -> DataFrame:
    """R5."""
    return (tracks_per_artist(m).withColumnRenamed("artist", "name")
            .orderBy(_desc("track_count"), "name").limit(n))


def top_genres_by_track_count(m: Model, n: int = 10) -> DataFrame:
    """Tracks per genre_id through the bridge (no genre-name join)."""
    per_artist = m.tracks.groupBy("artist_id").agg(F.count("track_id").alias("n"))
    return (m.artist_genres.join(per_artist, "artist_id").groupBy("genre_id")
            .agg(F.sum("n").cast("long").alias("track_count"))
            .orderBy(_desc("track_count"), "genre_id").limit(n))


def energy_dance_by_genre(m: Model) -> DataFrame:
    """R7."""
    return (_genre_feature_avgs(m, ("danceability", "energy"))
            .orderBy(_desc("avg_energy"), "genre"))


def tracks_by_decade(m: Model) -> DataFrame:
    """Integer-division decade of release_year."""
    return (m.tracks.filter(F.col("release_year").isNotNull())
            .groupBy(int_div("release_year", "10").alias("_d"))
            .agg(F.count(F.lit(1)).alias("track_count"))
            .select((F.col("_d") * 10).cast("long").alias("decade"), "track_count")
            .orderBy("decade"))


def top_tracks_by_feature(m: Model, feature: str, n: int = 10, ascending: bool = False,
                          with_artist: bool = True) -> DataFrame:
    """N tracks by one audio feature."""
    f = m.audio_features.select("track_id", feature)
    base = track_artist(m) if with_artist else m.tracks.select("track_id", "title")
    order = F.col(feature).asc_nulls_last() if ascending else _desc(feature)
    cols = [F.col("title").alias("track")] + ([F.col("name").alias("artist")] if with_artist else [])
    return base.join(f, "track_id").orderBy(order, "track_id").limit(n).select(*cols, feature)


# -------------------------------------------------------------- genre reports
def clean_genres(m: Model) -> DataFrame:
    """R15 (view): first character A-Z or a-z (code points 65-122 minus 91-96), length 3-39."""
    first = F.ascii(F.substring("name", 1, 1))
    return m.genres.filter(first.between(65, 122) & ~first.between(91, 96)
                           & (F.length("name") < 40) & (F.length("name") > 2))


def genre_match_rate(m: Model) -> DataFrame:
    """Artists with an external id, as a percentage (round 1)."""
    a = m.artists.agg(F.count(F.lit(1)).alias("total_artists"),
                      F.count("mbid").alias("mb_match"))
    return a.select("total_artists", "mb_match",
                    num_round(F.col("mb_match") * 100.0 / F.col("total_artists"), 1)
                    .alias("match_rate"))


def top_genres_by_plays(m: Model, n: int = 20) -> DataFrame:
    """Plays per clean genre; a play counts once per genre of its artist."""
    return (genre_bridge(m, clean=True).join(_plays_by_artist(m), "artist_id")
            .groupBy("genre").agg(F.sum("plays").alias("plays"))
            .orderBy(_desc("plays"), "genre").limit(n))


def top_artist_per_genre(m: Model) -> DataFrame:
    """Per clean genre the artist(s) with the most plays (dense_rank 1, ties kept)."""
    per_artist = _plays_by_artist(m).join(m.artists.select("artist_id", "name"), "artist_id")
    ga = (genre_bridge(m, clean=True).join(per_artist, "artist_id")
          .groupBy("genre", F.col("name").alias("artist")).agg(F.sum("plays").alias("plays")))
    w = Window.partitionBy("genre").orderBy(_desc("plays"))
    return (ga.withColumn("_r", F.dense_rank().over(w)).filter(F.col("_r") <= 1)
            .select("genre", "artist", "plays").orderBy(_desc("plays"), "genre", "artist"))


def skips_by_genre(m: Model, n: int = 50) -> DataFrame:
    """Total skips per raw genre (D17: a total, not a rate)."""
    return (genre_bridge(m).join(_plays_by_artist(m), "artist_id")
            .groupBy(F.col("genre").alias("name")).agg(F.sum("skips").alias("skips"))
            .orderBy(_desc("skips"), "name").limit(n))


def top_genres_per_year(m: Model, k: int = 5) -> DataFrame:
    """rank() of clean genres by plays within each play year, keep rank <= k."""
    yearly = m.plays.withColumn("year", F.year("played_at"))
    per_artist_year = (yearly.groupBy("track_id", "year").agg(F.sum("play_count").alias("plays"))
                       .join(m.tracks.select("track_id", "artist_id"), "track_id")
                       .groupBy("artist_id", "year").agg(F.sum("plays").alias("plays")))
    gy = (genre_bridge(m, clean=True).join(per_artist_year, "artist_id")
          .groupBy("genre", "year").agg(F.sum("plays").alias("plays")))
    w = Window.partitionBy("year").orderBy(_desc("plays"))
    return (gy.withColumn("_r", F.rank().over(w)).filter(F.col("_r") <= k)
            .select("genre", "year", "plays")
            .orderBy(F.col("year").desc(), _desc("plays"), "genre"))


# -------------------------------------------------------- listening behaviour
def _title_artist_plays(m: Model, plays_df: DataFrame | None = None) -> DataFrame:
    p = plays_df if plays_df is not None else m.plays
    per_track = p.groupBy("track_id").agg(F.sum("play_count").alias("plays"))
    return (per_track.join(track_artist(m), "track_id")
            .groupBy("title", "name").agg(F.sum("plays").alias("plays")))


def top_tracks(m: Model, n: int = 20) -> DataFrame:
    """Plays per (title, artist name)."""
    return _title_artist_plays(m).orderBy(_desc("plays"), "title", "name").limit(n)


def top_tracks_in_year(m: Model, year: int = 2026, n: int = 200) -> DataFrame:
    """As R21 for one calendar year.

    The year is a half-open timestamp range, which Parquet can prune by row-group
    statistics; ``year(played_at) = y`` could not be pushed to the scan.
    """
    lo = _dt.datetime(year, 1, 1)
    hi = _dt.datetime(year + 1, 1, 1)
    p = m.plays.filter((F.col("played_at") >= ntz_literal(lo))
                       & (F.col("played_at") < ntz_literal(hi)))
    if "play_year" in m.plays.columns:  # year-partitioned table: prune directories too
        p = p.filter(F.col("play_year") == year)
    return _title_artist_plays(m, p).orderBy(_desc("plays"), "title", "name").limit(n)


def listening_minutes_by_year(m: Model) -> DataFrame:
    """Integer minutes per play year."""
    return (m.plays.groupBy(F.year("played_at").alias("listen_year"))
            .agg(F.sum("play_duration_ms").alias("_ms"))
            .select("listen_year", int_div("_ms", "60000").alias("yearly_listening_min"))
            .orderBy("listen_year"))


def listening_minutes_by_month_of_year(m: Model) -> DataFrame:
    """Integer minutes per calendar month, all years pooled."""
    return (m.plays.groupBy(F.month("played_at").alias("listen_month"))
            .agg(F.sum("play_duration_ms").alias("_ms"))
            .select("listen_month", int_div("_ms", "60000").alias("monthly_listening_min"))
            .orderBy("listen_month"))


def _artist_totals(m: Model) -> DataFrame:
    return (_plays_by_artist(m).join(m.artists.select("artist_id", "name"), "artist_id")
            .groupBy("name").agg(F.sum("plays").alias("plays"), F.sum("skips").alias("skips")))


def top_artists(m: Model, n: int = 20) -> DataFrame:
    """R25."""
    return (_artist_totals(m).select("name", "plays")
            .orderBy(_desc("plays"), "name").limit(n))


def skips_by_artist(m: Model, n: int = 50) -> DataFrame:
    """R26 (D17: total skips)."""
    return (_artist_totals(m).select("name", "skips")
            .orderBy(_desc("skips"), "name").limit(n))


def loyalty_ratio(m: Model, min_plays: int = 1000, n: int = 50) -> DataFrame:
    """Laplace-smoothed plays/skips ratio for artists above a play count."""
    t = _artist_totals(m).filter(F.col("plays") > min_plays)
    ratio = ((F.col("plays") + 1).cast("double") / (F.col("skips") + 1).cast("double"))
    return (t.select("name", "plays", "skips", ratio.alias("ratio"))
            .orderBy(_desc("ratio"), "name").limit(n))


def loyalty_ratio_rounded(m: Model, min_plays: int = 1000, n: int = 50) -> DataFrame:
    """R27 rounded to 3 places, with the published column names."""
    t = _artist_totals(m).filter(F.col("plays") > min_plays)
    ratio = ((F.col("plays") + 1).cast("double") / (F.col("skips") + 1).cast("double"))
    return (t.select(F.col("name").alias("artist_name"), F.col("plays").alias("total_plays"),
                     F.col("skips").alias("total_skips"), num_round(ratio, 3).alias("loyalty_ratio"))
            .orderBy(_desc("loyalty_ratio"), "artist_name").limit(n))


# ------------------------------------------------------------ catalog windows
def _track_genre_rows(m: Model) -> DataFrame:
    """tracks ⋈ artists ⋈ artist_genres ⋈ genres: one row per track and artist genre."""
    return track_artist(m).join(genre_bridge(m), "artist_id")


def genre_avg_energy_window(m: Model) -> DataFrame:
    """Every (genre, track) row with its genre's average energy.

    ``avg() OVER (PARTITION BY genre)`` is computed as a per-genre aggregate (partial
    aggregation map-side) joined back, so a genre holding most rows is not one task.
    """
    # sums per artist first: the bridge then fans out one row an artist, not one a track
    avgs = (genre_bridge(m).join(_features_by_artist(m, ["energy"]), "artist_id").groupBy("genre")
            .agg((F.sum("s_energy") / F.sum("n_energy")).alias("avg_energy")))
    rows = (m.tracks.select("track_id", "title", "artist_id")
            .join(m.audio_features.select("track_id", "energy"), "track_id")
            .join(genre_bridge(m).join(avgs, "genre"), "artist_id"))
    return rows.select("genre", "energy", "title", "avg_energy")


def dance_rank_in_genre(m: Model) -> DataFrame:
    """Rank and dense_rank by danceability within genre (range-partitioned ranks)."""
    rows = (_track_genre_rows(m).join(m.audio_features.select("track_id", "danceability"), "track_id")
            .select("title", F.col("name").alias("artist"), "genre", "danceability"))
    return grouped_ranks(rows, ["genre"], [("danceability", False)],
                         {"dance_rank": "rank", "dense_dance_rank": "dense_rank"})


def release_order_in_genre(m: Model) -> DataFrame:
    """row_number by release year (newest first, then track_id) within genre."""
    rows = (track_artist(m, "release_year").filter(F.col("release_year").isNotNull())
            .join(genre_bridge(m), "artist_id"))
    out = grouped_row_number(rows, ["genre"], [("release_year", False), ("track_id", True)],
                             "release_row_no")
    return out.select("title", F.col("name").alias("artist"), "genre", "release_year",
                      "release_row_no")


def length_percent_rank_in_genre(m: Model) -> DataFrame:
    """percent_rank of duration (longest first) within genre."""
    rows = (track_artist(m, "duration_ms").filter(F.col("duration_ms").isNotNull())
            .join(genre_bridge(m), "artist_id")
            .select("title", F.col("name").alias("artist"), "genre",
                    F.col("duration_ms").alias("length")))
    return grouped_rank(rows, ["genre"], [("length", False)], "length_percent_rank", "percent_rank")


# ------------------------------------------------------- play-history windows
def top_tracks_per_year(m: Model, k: int = 10) -> DataFrame:
    """Top k (title, artist) per play year by plays (row_number)."""
    per = (m.plays.groupBy("track_id", F.year("played_at").alias("year"))
           .agg(F.sum("play_count").alias("plays"))
           .join(track_artist(m), "track_id")
           .groupBy("title", F.col("name").alias("artist"), "year").agg(F.sum("plays").alias("plays")))
    w = Window.partitionBy("year").orderBy(_desc("plays"), "title", "artist")
    return (per.withColumn("rank", F.row_number().over(w).cast("long"))
            .filter(F.col("rank") <= k)
            .select("title", "artist", "year", "plays", "rank").orderBy("year", "rank"))


def top_artists_per_year(m: Model, k: int = 10) -> DataFrame:
    """Top k artists per play year by plays (row_number)."""
    per = (m.plays.groupBy("track_id", F.year("played_at").alias("year"))
           .agg(F.sum("play_count").alias("plays"))
           .join(m.tracks.select("track_id", "artist_id"), "track_id")
           .groupBy("artist_id", "year").agg(F.sum("plays").alias("plays"))
           .join(m.artists.select("artist_id", "name"), "artist_id")
           .groupBy(F.col("name").alias("artist"), "year").agg(F.sum("plays").alias("plays")))
    w = Window.partitionBy("year").orderBy(_desc("plays"), "artist")
    return (per.withColumn("rank", F.row_number().over(w).cast("long"))
            .filter(F.col("rank") <= k)
            .select("artist", "year", "plays", "rank").orderBy("year", "rank"))


def top_track_per_month(m: Model) -> DataFrame:
    """The most played (title, artist) of each month, with month name and YYYY-MM."""
    per = (m.plays.groupBy("track_id", month_start("played_at").alias("month"))
           .agg(F.sum("play_count").alias("plays"))
           .join(track_artist(m), "track_id")
           .groupBy("title", F.col("name").alias("artist"), "month").agg(F.sum("plays").alias("plays")))
    w = Window.partitionBy("month").orderBy(_desc("plays"), "title", "artist")
    return (per.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= 1)
            .select("title", "artist", month_name_padded("month").alias("month_name"),
                    year_month("month").alias("year_month"), "plays")
            .orderBy("year_month", "month_name"))


def _repeat_stats(m: Model) -> DataFrame:
    """Per (title, artist): number of play-days and total plays; stored, as ranking reads it twice."""
    per_track = m.plays.groupBy("track_id").agg(F.count(F.lit(1)).alias("days"),
                                                 F.sum("play_count").alias("plays"))
    return cut_lineage(per_track.join(track_artist(m), "track_id")
                       .groupBy("title", F.col("name").alias("artist"))
                       .agg(F.sum("days").alias("days_played"), F.sum("plays").alias("_plays")))


def most_repeated_tracks(m: Model) -> DataFrame:
    """Days played, average plays per day, global rank by that average.

    The unpartitioned rank is computed by :func:`global_rank` (range partitions +
    offsets) instead of a single-task window.
    """
    s = _repeat_stats(m).withColumn("avg_per_day", F.col("_plays") / F.col("days_played"))
    return global_rank(s, [("avg_per_day", False)], "rank").select(
        "title", "artist", "days_played", "avg_per_day", "rank")


def most_repeated_tracks_min_days(m: Model, min_days: int = 30) -> DataFrame:
    """R36 restricted to more than ``min_days`` days; rank on the unrounded average."""
    s = (_repeat_stats(m).filter(F.col("days_played") > min_days)
         .withColumn("_avg", F.col("_plays") / F.col("days_played")))
    r = global_rank(s, [("_avg", False)], "pipeline_rank")
    return r.select(F.col("title").alias("track_title"), F.col("artist").alias("artist_name"),
                    "days_played", num_round("_avg", 3).alias("avg_plays_per_day"),
                    "pipeline_rank")


def artist_discovery(m: Model) -> DataFrame:
    """First listen per artist, ranked newest first."""
    per_track = m.plays.groupBy("track_id").agg(F.min("played_at").alias("first_listen"))
    first = cut_lineage(per_track.join(track_artist(m), "track_id").groupBy(F.col("name").alias("artist"))
                        .agg(F.min("first_listen").alias("first_listen")))
    return global_rank(first, [("first_listen", False)], "rank").select(
        "artist", "first_listen", "rank")


def plays_per_month(m: Model) -> DataFrame:
    """Plays per calendar month of each year."""
    per = m.plays.groupBy(month_start("played_at").alias("month")).agg(
        F.sum("play_count").alias("plays"))
    return (per.select("plays", month_name_padded("month").alias("month_name"),
                       year_month("month").alias("year_month"))
            .orderBy("year_month", "month_name"))
