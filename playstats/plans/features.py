"""Feature views F1-F4 and the distributions over them.

Plan shape: plays are aggregated per track first (one partial + final hash
aggregate), dimensions are joined to that per-track frame, and the artist's
clean-genre list is built per *artist* and joined by artist_id (one small
collection per artist instead of one per track). The global statistics of F3 are
one aggregate pass producing a single row, broadcast to every task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.functions.exprs import (affinity_tier, listening_pattern, num_round, one_hot,
                                       seconds_between, skip_behavior)
from playstats.model import Model
from playstats.plans.reports import clean_genres
from playstats.session import cut_lineage

# The 21 model features in the reference's recommender order.
Z_MEASURES = ("log_total_plays", "log_total_skips", "log_days_played", "log_listening_period",
              "log_skip_adj_pop", "session_intensity", "recency_score", "loyalty_index",
              "genre_diversity")
ONE_HOTS = ("affinity_loved", "affinity_liked", "affinity_casual", "affinity_tried",
            "skip_high", "skip_moderate", "skip_low", "skip_never",
            "pattern_long_term", "pattern_regular", "pattern_occasional", "pattern_rare")
FEATURE_COLS = tuple(f"z_{c}" for c in Z_MEASURES) + ONE_HOTS

DEFAULT_AS_OF = _dt.date(2001, 12, 1)


def _genre_lists(m: Model, genres: DataFrame) -> DataFrame:
    """Per artist: sorted ', '-joined genre names (artists without genres absent)."""
    per_artist = (m.artist_genres.join(genres.select("genre_id", "name"), "genre_id")
                  .join(m.artists.select("artist_id"), "artist_id")
                  .groupBy("artist_id")
                  .agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("genres")))
    return per_artist


def track_features(m: Model) -> DataFrame:
    """per-track play statistics, clean-genre tags and three text labels."""
    # count(distinct played_at) as two aggregation levels (per track-day, then per
    # track) instead of Spark's Expand-based distinct rewrite, which doubles the rows
    # going into the shuffle.
    per_day = m.plays.groupBy("track_id", "played_at").agg(
        F.sum("play_count").alias("_p"), F.sum("skip_count").alias("_s"),
        F.sum("play_duration_ms").alias("_ms"), F.count("play_duration_ms").alias("_n"))
    per_track = per_day.groupBy("track_id").agg(
        F.sum("_p").alias("total_plays"),
        F.sum("_s").alias("total_skips"),
        (F.sum("_ms") / F.sum("_n")).alias("avg_play_duration_sec"),
        F.count("played_at").alias("days_played"),
        F.min("played_at").alias("first_played"),
        F.max("played_at").alias("last_played"))
    ta = m.tracks.select("track_id", "title", "artist_id").join(
        m.artists.select("artist_id", F.col("name").alias("artist")), "artist_id")
    ps = per_track.join(ta, "track_id")
    skip_rate = num_round(F.col("total_skips").cast("double")
                          / F.when(F.col("total_plays") != 0, F.col("total_plays").cast("double"))
                          * 100, 2)
    ps = ps.select(
        "track_id", "title", "artist_id", "artist", "total_plays", "total_skips",
        skip_rate.alias("skip_rate"), "avg_play_duration_sec",
        (F.col("avg_play_duration_sec") / 1000.0).alias("avg_play_duration_s"),
        "days_played", "first_played", "last_played",
        (F.col("last_played") - F.col("first_played")).alias("listening_period"))
    gl = _genre_lists(m, clean_genres(m))
    out = ps.join(gl, "artist_id", "left")
    return out.select(
        "track_id", "title", "artist", "total_plays", "total_skips", "skip_rate",
        "avg_play_duration_sec", "avg_play_duration_s", "days_played", "first_played",
        "last_played", "listening_period", "genres",
        affinity_tier("total_plays").alias("affinity_tier"),
        skip_behavior("skip_rate").alias("skip_behavior"),
        listening_pattern("days_played").alias("listening_pattern"))


def _engineered_from(tf: DataFrame, as_of: _dt.date) -> DataFrame:
    b = tf.select(
        "track_id", "title", "artist", "total_plays", "total_skips", "skip_rate", "days_played",
        "first_played", "last_played", "listening_period", "avg_play_duration_sec", "genres",
        F.datediff(F.lit(as_of), F.to_date("last_played")).alias("days_since_last_play"),
        F.when(F.col("genres").isNotNull(), F.size(F.split("genres", ", ")))
        .alias("genre_count"))
    plays, days, rate = F.col("total_plays"), F.col("days_played"), F.col("skip_rate")
    keep = 1 - rate / 100.0
    period_days = F.extract(F.lit("DAY"), F.col("listening_period"))
    period_zero = F.col("last_played") == F.col("first_played")
    return b.select(
        "*",
        F.when(days == 0, F.lit(0.0)).otherwise(plays.cast("double") / days)
        .alias("session_intensity"),
        F.exp(-F.col("days_since_last_play").cast("double") / 30.0).alias("recency_score"),
        F.when(period_zero, F.lit(0.0))
        .otherwise((days - period_days).cast("double") * keep).alias("loyalty_index"),
        (plays.cast("double") * keep).alias("skip_adjusted_popularity"),
        F.coalesce(F.col("genre_count"), F.lit(1)).alias("genre_diversity"),
        one_hot(plays >= 20).alias("affinity_loved"),
        one_hot(plays.between(10, 19)).alias("affinity_liked"),
        one_hot(plays.between(3, 9)).alias("affinity_casual"),
        one_hot(plays < 3).alias("affinity_tried"),
        one_hot(rate > 50).alias("skip_high"),
        one_hot(rate.between(31, 50)).alias("skip_moderate"),
        one_hot(rate == 0).alias("skip_never"),
        one_hot(rate.between(1, 30)).alias("skip_low"),
        one_hot(days > 50).alias("pattern_long_term"),
        one_hot(days.between(21, 50)).alias("pattern_regular"),
        one_hot(days.between(11, 20)).alias("pattern_occasional"),
        one_hot(days <= 10).alias("pattern_rare"))


def track_features_engineered(m: Model, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """recency (against a fixed ``as_of`` date), intensity, loyalty, one-hots."""
    return _engineered_from(track_features(m), as_of)


def _ln1p_pos(c: Column) -> Column:
    return F.ln(1 + F.greatest(c.cast("double"), F.lit(0.0)))


def clean_base(eng: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The nine measures before scaling (F3 ``base``): tracks with at least 2 plays.

    ``carry`` names further columns of F2 to keep.
    """
    period_s = seconds_between("first_played", "last_played")
    return eng.filter(F.col("total_plays") >= 2).select(
        "track_id",
        _ln1p_pos(F.col("total_plays")).alias("log_total_plays"),
        _ln1p_pos(F.col("total_skips")).alias("log_total_skips"),
        _ln1p_pos(F.col("days_played")).alias("log_days_played"),
        _ln1p_pos(period_s / 86400.0).alias("log_listening_period"),
        _ln1p_pos(F.col("skip_adjusted_popularity")).alias("log_skip_adj_pop"),
        F.col("session_intensity").cast("double").alias("session_intensity"),
        "recency_score",
        F.col("loyalty_index").cast("double").alias("loyalty_index"),
        F.col("genre_diversity").cast("double").alias("genre_diversity"),
        *ONE_HOTS, *carry)


def measure_stats(base: DataFrame) -> DataFrame:
    """One aggregate pass: mean and population sd of the nine measures (one row)."""
    aggs = []
    for c in Z_MEASURES:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"sd_{c}")]
    return base.agg(*aggs)


def track_features_clean(m: Model, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """z-scores of log-scaled measures plus the 12 unscaled one-hots."""
    return clean_from_engineered(track_features_engineered(m, as_of))


def clean_from_engineered(eng: DataFrame, checkpoint_base: bool = True,
                          carry: tuple[str, ...] = ()) -> DataFrame:
    """F3 from an F2 frame.

    ``base`` feeds both the statistics pass and the scaling; one checkpoint
    (per-track rows, far smaller than plays) avoids running the play aggregation
    twice. Callers that pass an already checkpointed F2 skip it.
    """
    base = clean_base(eng, carry)
    if checkpoint_base:
        base = cut_lineage(base)
    stats = measure_stats(base)
    # stats is exactly one row: a broadcast nested-loop join of fixed size.
    j = base.crossJoin(F.broadcast(stats))
    z = [((F.col(c) - F.col(f"mean_{c}")) / F.when(F.col(f"sd_{c}") != 0, F.col(f"sd_{c}")))
         .alias(f"z_{c}") for c in Z_MEASURES]
    return j.select("track_id", *z, *ONE_HOTS, *carry)


def check_constant_features(m: Model, as_of: _dt.date = DEFAULT_AS_OF) -> DataFrame:
    """Mean and sd of each scaled measure; ``is_constant`` marks a zero/NULL sd, which
    makes that z column NULL for every row (and so empties the feature matrix)."""
    stats = measure_stats(clean_base(track_features_engineered(m, as_of)))
    rows = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(f"mean_{c}").alias("mean"),
                              F.col(f"sd_{c}").alias("sd")) for c in Z_MEASURES])
    return (stats.select(F.inline(rows))
            .withColumn("is_constant", F.coalesce(F.col("sd") == 0, F.lit(True))))


def feature_matrix(m: Model, as_of: _dt.date = DEFAULT_AS_OF, with_vector: bool = True) -> DataFrame:
    """F3 + track name, artist name, raw genre list; rows with a NULL feature dropped.

    ``features`` packs the 21 columns into ``array<double>`` for the distance operators.
    """
    f3 = track_features_clean(m, as_of)
    ta = m.tracks.select("track_id", F.col("title").alias("track_name"), "artist_id").join(
        m.artists.select("artist_id", F.col("name").alias("artist_name")), "artist_id")
    gl = _genre_lists(m, m.genres)
    out = (f3.join(ta, "track_id").join(gl, "artist_id", "left")
           .select("track_id", "track_name", "artist_name", "genres", *FEATURE_COLS)
           .dropna(subset=list(FEATURE_COLS)))
    if with_vector:
        out = out.withColumn("features", F.array(*[F.col(c).cast("double") for c in FEATURE_COLS]))
    return out


def affinity_distribution(m: Model) -> DataFrame:
    """Tracks per affinity tier."""
    return (track_features(m).groupBy("affinity_tier").agg(F.count(F.lit(1)).alias("track_count"))
            .orderBy(F.col("track_count").desc(), "affinity_tier"))


def skip_behavior_distribution(m: Model) -> DataFrame:
    """Tracks per skip class."""
    return (track_features(m).groupBy("skip_behavior").agg(F.count(F.lit(1)).alias("track_count"))
            .orderBy(F.col("track_count").desc(), "skip_behavior"))
