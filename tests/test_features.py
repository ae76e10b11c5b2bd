import datetime as dt

from pyspark.sql import functions as F

from playstats.model import Model
from playstats.plans import features as FT
from playstats.plans import reports as R


def _model(spark, plays, n_tracks):
    artists = spark.createDataFrame([(1, "Art", None, None)],
                                    "artist_id long, name string, mbid string, country string")
    tracks = spark.createDataFrame([(i, f"T{i}", 1, "a", 2000, 1000) for i in range(1, n_tracks + 1)],
                                   "track_id long, title string, artist_id long, album string, "
                                   "release_year int, duration_ms int")
    genres = spark.createDataFrame([(1, "Rock"), (2, "pop")], "genre_id long, name string")
    ag = spark.createDataFrame([(1, 1), (1, 2)], "artist_id long, genre_id long")
    af = spark.createDataFrame([], "track_id long, tempo double, energy double, valence double, "
                                   "acousticness double, speechiness double, danceability double")
    p = spark.createDataFrame(plays, "track_id long, played_at timestamp_ntz, play_duration_ms long, "
                                     "play_count int, skip_count int")
    return Model(artists, tracks, p, genres, ag, af)


def _day(i):
    return dt.datetime(2001, 1, 1) + dt.timedelta(days=i)


def test_affinity_and_pattern_edges(spark):
    totals = [1, 2, 3, 9, 10, 19, 20]
    plays = [(i + 1, _day(0), 100, t, 0) for i, t in enumerate(totals)]
    m = _model(spark, plays, len(totals))
    tiers = {r.total_plays: r.affinity_tier for r in FT.track_features(m).collect()}
    assert tiers == {1: "tried", 2: "tried", 3: "casual fan", 9: "casual fan", 10: "liked",
                     19: "liked", 20: "loved"}
    days = [10, 11, 20, 21, 50, 51]
    plays = [(i + 1, _day(d), 100, 1, 0) for i, n in enumerate(days) for d in range(n)]
    m = _model(spark, plays, len(days))
    pat = {r.days_played: r.listening_pattern for r in FT.track_features(m).collect()}
    assert pat == {10: "rare", 11: "occasional", 20: "occasional", 21: "regular", 50: "regular",
                   51: "long term"}
    eng = {r.days_played: (r.pattern_rare, r.pattern_occasional, r.pattern_regular, r.pattern_long_term)
           for r in FT.track_features_engineered(m).collect()}
    assert eng[10] == (1, 0, 0, 0) and eng[51] == (0, 0, 0, 1) and eng[21] == (0, 0, 1, 0)


def test_skip_rate_edges_and_gaps(spark):
    # (plays, skips) -> skip_rate
    cases = [(200, 0), (200, 1), (100, 1), (100, 30), (200, 61), (100, 31), (100, 50),
             (10000, 5001), (10, 12)]
    plays = [(i + 1, _day(0), 100, p, s) for i, (p, s) in enumerate(cases)]
    m = _model(spark, plays, len(cases))
    got = {r.track_id: (r.skip_rate, r.skip_behavior, r.skip_high, r.skip_moderate, r.skip_never,
                        r.skip_low)
           for r in FT.track_features_engineered(m).join(
               FT.track_features(m).select("track_id", "skip_behavior"), "track_id").collect()}
    assert got[1] == (0.0, "never skipped", 0, 0, 1, 0)
    assert got[2] == (0.5, "low skip", 0, 0, 0, 0)          # D5: gap (0, 1) has no one-hot
    assert got[3] == (1.0, "low skip", 0, 0, 0, 1)
    assert got[4] == (30.0, "low skip", 0, 0, 0, 1)
    assert got[5] == (30.5, "moderate skip", 0, 0, 0, 0)    # D5: gap (30, 31)
    assert got[6] == (31.0, "moderate skip", 0, 1, 0, 0)
    assert got[7] == (50.0, "moderate skip", 0, 1, 0, 0)
    assert got[8] == (50.01, "high skip", 1, 0, 0, 0)
    assert got[9] == (120.0, "high skip", 1, 0, 0, 0)


def test_null_skip_rate_zero_plays(spark):
    m = _model(spark, [(1, _day(0), 100, 0, 0)], 1)
    r = FT.track_features_engineered(m).first()
    assert r.skip_rate is None
    assert FT.track_features(m).first().skip_behavior == "low skip"    # D6
    assert (r.skip_high, r.skip_moderate, r.skip_never, r.skip_low) == (0, 0, 0, 0)
    assert r.loyalty_index == 0.0   # single day: period 0


def test_loyalty_ratio_published_rows(spark):
    # README snapshot rows: (plays, skips) -> ratio rounded to 3
    cases = [(1674, 144, 11.552), (1766, 185, 9.500), (1049, 115, 9.052), (1796, 217, 8.243),
             (1769, 225, 7.832)]
    artists = spark.createDataFrame([(i, f"A{i}", None, None) for i in range(len(cases))],
                                    "artist_id long, name string, mbid string, country string")
    tracks = spark.createDataFrame([(i, "t", i, "a", 2000, 1) for i in range(len(cases))],
                                   "track_id long, title string, artist_id long, album string, "
                                   "release_year int, duration_ms int")
    plays = spark.createDataFrame([(i, _day(0), 1, p, s) for i, (p, s, _) in enumerate(cases)],
                                  "track_id long, played_at timestamp_ntz, play_duration_ms long, "
                                  "play_count int, skip_count int")
    m = Model(artists, tracks, plays, None, None, None)
    got = {r.total_plays: r.loyalty_ratio for r in R.loyalty_ratio_rounded(m).collect()}
    assert got == {p: r for p, s, r in cases}


def test_z_scores_are_standardised(spark, small_model):
    c = FT.track_features_clean(small_model)
    for z in ("z_log_total_plays", "z_recency_score", "z_log_days_played"):
        mean, sd = c.agg(F.avg(z), F.stddev_pop(z)).first()
        assert abs(mean) < 1e-9 and abs(sd - 1) < 1e-9
    # one-hot groups: affinity and pattern sum to 1, skip to 0 or 1
    s = c.select((F.col("affinity_loved") + F.col("affinity_liked") + F.col("affinity_casual")
                  + F.col("affinity_tried")).alias("a"),
                 (F.col("skip_high") + F.col("skip_moderate") + F.col("skip_never")
                  + F.col("skip_low")).alias("s")).distinct().collect()
    assert {r.a for r in s} == {1} and {r.s for r in s} <= {0, 1}


def test_constant_feature_is_reported(spark):
    plays = [(i + 1, _day(0), 100, 5, 0) for i in range(4)]
    m = _model(spark, plays, 4)
    const = {r.measure: r.is_constant for r in FT.check_constant_features(m).collect()}
    assert const["log_total_plays"] is True


def test_loyalty_index_as_written(spark):
    # (days_played - whole days of the listening period) * (1 - skip_rate / 100)
    plays = [(1, _day(d), 100, 2, 1 if d == 0 else 0) for d in range(30)]      # 30 days, span 29
    plays += [(2, _day(0), 100, 3, 0), (2, _day(9), 100, 1, 0)]               # 2 days, span 9
    m = _model(spark, plays, 2)
    got = {r.track_id: (r.days_played, r.skip_rate, r.loyalty_index, r.session_intensity)
           for r in FT.track_features_engineered(m).collect()}
    d, rate, loyalty, intensity = got[1]
    assert (d, rate) == (30, round(1 / 60 * 100, 2))
    assert abs(loyalty - (30 - 29) * (1 - rate / 100.0)) < 1e-12
    assert abs(intensity - 2.0) < 1e-12
    assert got[2][2] == (2 - 9) * 1.0 and got[2][3] == 2.0
