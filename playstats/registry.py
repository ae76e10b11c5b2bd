"""Query keys -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Parameters follow FIXTURES.md: R2 uses genre 'PROMO', R22 the year 1998, the
feature views ``as_of`` 2001-12-01.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playstats.checks import oracle_sql as _oracle
from playstats.plans import reports as R
from playstats.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _m(spark: SparkSession, sf_dir: str):
    return fixtures.model(spark, sf_dir)


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


def _report(key: str, fn, **kw):
    QUERIES[key] = lambda spark, sf_dir: fn(_m(spark, sf_dir), **kw)


def _rounded(df: DataFrame, cols, digits: int) -> DataFrame:
    # "+ 0.0" turns a rounded -0.0 into 0.0 so both engines print the same zero.
    return df.withColumns({c: F.round(F.col(c), digits) + F.lit(0.0) for c in cols})


# ---- reports R1-R39
_report("audio_profile_by_genre", R.audio_profile_by_genre)
_report("genre_high_valence", R.genre_high_valence, genre="PROMO", min_valence=0.95, n=25)
_report("tracks_per_artist", R.tracks_per_artist)
_report("avg_valence_per_artist", R.avg_valence_per_artist)
_report("avg_valence_per_artist_as_written", R.avg_valence_per_artist, as_written=True)
_report("top_artists_by_track_count", R.top_artists_by_track_count, n=20)
_report("top_genres_by_track_count", R.top_genres_by_track_count, n=10)
_report("energy_dance_by_genre", R.energy_dance_by_genre)
_report("tracks_by_decade", R.tracks_by_decade)
_report("top_danceable", R.top_tracks_by_feature, feature="danceability")
_report("least_energetic", R.top_tracks_by_feature, feature="energy", ascending=True)
_report("top_tempo", R.top_tracks_by_feature, feature="tempo")
_report("top_valence", R.top_tracks_by_feature, feature="valence")
_report("top_acoustic", R.top_tracks_by_feature, feature="acousticness")
_report("top_speechy", R.top_tracks_by_feature, feature="speechiness", with_artist=False)
_report("clean_genres", R.clean_genres)
_report("genre_match_rate", R.genre_match_rate)
_report("top_genres_by_plays", R.top_genres_by_plays, n=20)
_report("top_artist_per_genre", R.top_artist_per_genre)
_report("skips_by_genre", R.skips_by_genre, n=50)
_report("top_genres_per_year", R.top_genres_per_year, k=5)
_report("top_tracks", R.top_tracks, n=20)
_report("top_tracks_in_year", R.top_tracks_in_year, year=1998, n=200)
_report("listening_minutes_by_year", R.listening_minutes_by_year)
_report("listening_minutes_by_month_of_year", R.listening_minutes_by_month_of_year)
_report("top_artists", R.top_artists, n=20)
_report("skips_by_artist", R.skips_by_artist, n=50)
_report("loyalty_ratio", R.loyalty_ratio, min_plays=1000, n=50)
_report("loyalty_ratio_rounded", R.loyalty_ratio_rounded, min_plays=1000, n=50)
QUERIES["genre_avg_energy_window"] = lambda s, d: _rounded(
    R.genre_avg_energy_window(_m(s, d)), ["avg_energy"], 9)
_report("dance_rank_in_genre", R.dance_rank_in_genre)
_report("release_order_in_genre", R.release_order_in_genre)
_report("length_percent_rank_in_genre", R.length_percent_rank_in_genre)
_report("top_tracks_per_year", R.top_tracks_per_year, k=10)
_report("top_artists_per_year", R.top_artists_per_year, k=10)
_report("top_track_per_month", R.top_track_per_month)
_report("most_repeated_tracks", R.most_repeated_tracks)
_report("most_repeated_tracks_min_days", R.most_repeated_tracks_min_days, min_days=30)
QUERIES["artist_discovery"] = lambda s, d: R.artist_discovery(_m(s, d)).withColumn(
    "first_listen", F.date_format("first_listen", "yyyy-MM-dd HH:mm:ss"))
_report("plays_per_month", R.plays_per_month)


def oracle() -> dict[str, str]:
    sql = _oracle.oracle_sql()
    return {k: v for k, v in sql.items() if k in QUERIES}


# ---- feature views, distributions, similarity
from playstats.plans import features as FT  # noqa: E402
from playstats.plans import recommend as RC  # noqa: E402
from playstats.functions.exprs import seconds_between  # noqa: E402

_TS_FMT = "yyyy-MM-dd HH:mm:ss"


def _ts_text(df: DataFrame, cols) -> DataFrame:
    return df.withColumns({c: F.date_format(c, _TS_FMT) for c in cols})


@register("track_features")
def _q_track_features(spark, sf_dir):
    tf = FT.track_features(_m(spark, sf_dir))
    tf = tf.withColumn("listening_period_s",
                       seconds_between("first_played", "last_played"))
    # averages of integer columns are the same IEEE operations in both engines: no
    # rounding (rounding could only add a tie-breaking difference at an exact .5)
    return _ts_text(tf, ["first_played", "last_played"]).drop("listening_period")


@register("track_features_engineered")
def _q_engineered(spark, sf_dir):
    e = FT.track_features_engineered(_m(spark, sf_dir)).drop("listening_period")
    e = _ts_text(e, ["first_played", "last_played"])
    # only exp() can differ in the last bit between engines; the other measures are
    # ratios and products of integers and rounded rates, computed identically
    return _rounded(e, ["recency_score"], 9)


@register("track_features_clean")
def _q_clean(spark, sf_dir):
    c = FT.track_features_clean(_m(spark, sf_dir))
    return _rounded(c, [f"z_{x}" for x in FT.Z_MEASURES], 6)


@register("feature_matrix")
def _q_fm(spark, sf_dir):
    fm = FT.feature_matrix(_m(spark, sf_dir), with_vector=False)
    return _rounded(fm, [f"z_{x}" for x in FT.Z_MEASURES], 6)


@register("check_constant_features")
def _q_const(spark, sf_dir):
    return _rounded(FT.check_constant_features(_m(spark, sf_dir)), ["mean", "sd"], 6)


_report("affinity_distribution", FT.affinity_distribution)
_report("skip_behavior_distribution", FT.skip_behavior_distribution)


@register("similar_tracks")
def _q_similar(spark, sf_dir):
    return _rounded(RC.similar_to_most_played(_m(spark, sf_dir), n=10), ["cosine_similarity"], 9)


@register("similar_tracks_named")
def _q_similar_named(spark, sf_dir):
    """S1 as the statement has it, by title and artist: those of the first track by title."""
    m = _m(spark, sf_dir)
    cand = RC.clean_with_names(m)      # the plays are aggregated once, for the track and for those like it
    first = cand.filter(F.col("total_plays") >= 2).orderBy("title", "track_id").select("title", "artist").first()
    return _rounded(RC.similar_tracks(m, first["title"], first["artist"], n=10, cand=cand), ["cosine_similarity"], 9)


@register("recommend_by_feature")
def _q_rec_feature(spark, sf_dir):
    fm = FT.feature_matrix(_m(spark, sf_dir), with_vector=False)
    out = RC.recommend_by_feature(fm, None, n=5)
    out = _rounded(out, [f"z_{x}" for x in FT.Z_MEASURES], 6)
    return _rounded(out, ["distance"], 9)


# ---- neighbours of every row, and the weighted neighbour graph
from playstats.operators.density import core_distances  # noqa: E402
from playstats.operators.knn import all_pairs_topk  # noqa: E402
from playstats.operators.neighbour_graph import knn_graph, neighbour_weights  # noqa: E402
from playstats.operators.reachability import mutual_reachability_forest  # noqa: E402
from playstats.operators.spectral import spectral_layout  # noqa: E402


@register("all_pairs_topk")
def _q_all_pairs(spark, sf_dir):
    return _rounded(all_pairs_topk(fixtures.table(spark, sf_dir, "embeddings"), 10, "vec_id", "embedding"), ["distance"], 9)


@register("all_pairs_topk_l2")
def _q_all_pairs_l2(spark, sf_dir):
    return _rounded(all_pairs_topk(fixtures.table(spark, sf_dir, "embeddings"), 10, "vec_id", "embedding", "l2"),
                    ["distance"], 9)


@register("similar_artists")
def _q_similar_artists(spark, sf_dir):
    return _rounded(RC.similar_artists(_m(spark, sf_dir), n=10), ["similarity_score"], 9)


@register("knn_graph")
def _q_knn_graph(spark, sf_dir):
    return _rounded(knn_graph(fixtures.table(spark, sf_dir, "embeddings"), 30, "vec_id", "embedding"), ["dist"], 9)


@register("neighbour_weights")
def _q_neighbour_weights(spark, sf_dir):
    edges = knn_graph(fixtures.table(spark, sf_dir, "embeddings"), 30, "vec_id", "embedding")
    return _rounded(neighbour_weights(edges, 30), ["weight"], 6)


@register("layout_spectral")
def _q_layout_spectral(spark, sf_dir):
    edges = knn_graph(fixtures.table(spark, sf_dir, "embeddings"), 30, "vec_id", "embedding")
    return spectral_layout(neighbour_weights(edges, 30), id_col="vec_id")


@register("core_distances")
def _q_core_distances(spark, sf_dir):
    at = fixtures.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return _rounded(core_distances(at, 20, id_col="vec_id"), ["core"], 9)


@register("mutual_reachability_forest")
def _q_mutual_reachability_forest(spark, sf_dir):
    at = fixtures.table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding")[0].alias("x"), F.col("embedding")[1].alias("y"))
    return _rounded(mutual_reachability_forest(at, 20, id_col="vec_id"), ["weight"], 9)


# ---- ingest, data quality, enrichment (inputs derived from the driver tables)
from playstats.operators import enrich as EN  # noqa: E402
from playstats.operators import ingest as IG  # noqa: E402
from playstats.operators import quality as DQ  # noqa: E402
from playstats.sources import derived as DV  # noqa: E402


def _history(spark, sf_dir):
    return IG.load_play_history(DV.raw_play_export(spark, sf_dir))


def _catalog(spark, sf_dir, match="title_artist"):
    return IG.load_song_catalog(DV.raw_song_catalog(spark, sf_dir), match)


@register("drop_null_rows")
def _q_drop_null(spark, sf_dir):
    return IG.drop_null_rows(DV.raw_play_export(spark, sf_dir), ["Track Description"])


@register("split_description")
def _q_split(spark, sf_dir):
    raw = DV.raw_play_export(spark, sf_dir).select(F.col("Track Description").alias("description"))
    return IG.split_description(raw, "description")


@register("parse_compact_date")
def _q_parse_date(spark, sf_dir):
    raw = DV.raw_play_export(spark, sf_dir).select(F.col("Date Played").alias("date_text"))
    return _ts_text(raw.withColumn("played_at", IG.parse_compact_date("date_text")), ["played_at"])


@register("dim_surrogate_keys")
def _q_dim(spark, sf_dir):
    return _history(spark, sf_dir)["artists"]


@register("build_tracks")
def _q_build_tracks(spark, sf_dir):
    return _history(spark, sf_dir)["tracks"]


@register("build_plays")
def _q_build_plays(spark, sf_dir):
    return _ts_text(_history(spark, sf_dir)["plays"], ["played_at"])


@register("dedupe_daily_plays")
def _q_dedupe(spark, sf_dir):
    raw = fixtures.plays_raw(spark, sf_dir)
    out = IG.keep_first(raw, ["track_id", "played_at"],
                        ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"],
                        ["play_duration_ms", "play_count", "skip_count"])
    return _ts_text(out.select("track_id", "played_at", "play_duration_ms", "play_count",
                               "skip_count"), ["played_at"])


@register("build_genres")
def _q_build_genres(spark, sf_dir):
    return _catalog(spark, sf_dir)["genres"]


@register("build_artist_genres")
def _q_build_artist_genres(spark, sf_dir):
    return _catalog(spark, sf_dir)["artist_genres"]


@register("build_catalog_tracks")
def _q_build_catalog_tracks(spark, sf_dir):
    return _catalog(spark, sf_dir)["tracks"]


@register("build_audio_features")
def _q_build_af(spark, sf_dir):
    return _catalog(spark, sf_dir)["audio_features"]


@register("build_audio_features_title_match")
def _q_build_af_title(spark, sf_dir):
    return _catalog(spark, sf_dir, "title")["audio_features"]


@register("load_summary")
def _q_load_summary(spark, sf_dir):
    tables = {f"history_{k}": v for k, v in _history(spark, sf_dir).items()}
    tables.update({f"catalog_{k}": v for k, v in _catalog(spark, sf_dir).items()})
    return IG.load_summary(tables)


@register("dq_duplicate_keys")
def _q_dq_dup(spark, sf_dir):
    dup = DQ.check_unique(fixtures.plays_raw(spark, sf_dir), ["track_id", "played_at"])
    return _ts_text(dup, ["played_at"])


_FKS = (("tracks.artist_id", "tracks", "artists", "artist_id"),
        ("plays.track_id", "plays", "tracks", "track_id"),
        ("artist_genres.artist_id", "artist_genres", "artists", "artist_id"),
        ("artist_genres.genre_id", "artist_genres", "genres", "genre_id"),
        ("audio_features.track_id", "audio_features", "tracks", "track_id"))


@register("dq_orphans")
def _q_dq_orphans(spark, sf_dir):
    m = _m(spark, sf_dir)
    frames = [DQ.check_orphans(getattr(m, child), getattr(m, parent), key)
              .agg(F.count(F.lit(1)).alias("orphan_count"))
              .select(F.lit(rel).alias("relation"), "orphan_count")
              for rel, child, parent, key in _FKS]
    return DQ.union_all(frames)


@register("dq_null_counts")
def _q_dq_nulls(spark, sf_dir):
    m = _m(spark, sf_dir)
    cols = {"plays": ["track_id", "played_at", "play_duration_ms", "play_count", "skip_count"]}
    return DQ.union_all([DQ.null_counts(getattr(m, t), t, cols.get(t)) for t in
                         ("artists", "tracks", "plays", "genres", "artist_genres", "audio_features")])


def _lookups(spark, sf_dir):
    return EN.parse_lookup(DV.landed_lookups(spark, sf_dir))


@register("parse_lookup")
def _q_parse_lookup(spark, sf_dir):
    return _lookups(spark, sf_dir).select("artist_id", "mbid", F.array_join("tags", "|").alias("tags"),
                                          "country", "status")


@register("pending_artists")
def _q_pending(spark, sf_dir):
    return EN.pending_artists(_m(spark, sf_dir).artists.select("artist_id", "name"),
                              _lookups(spark, sf_dir))


@register("apply_enrichment")
def _q_apply(spark, sf_dir):
    return EN.apply_enrichment(_m(spark, sf_dir).artists, _lookups(spark, sf_dir))


@register("explode_tags")
def _q_explode_tags(spark, sf_dir):
    return EN.explode_tags(_lookups(spark, sf_dir))


@register("tag_bridge")
def _q_tag_bridge(spark, sf_dir):
    lk = _lookups(spark, sf_dir)
    return EN.tag_bridge(lk, EN.explode_tags(lk))


@register("load_enrich_report")
def _q_load_enrich_report(spark, sf_dir):
    """Load the export, apply the lookups, run R16 and R17 on the loaded tables."""
    import uuid
    from playstats.session import ensure_checkpoint_dir
    from playstats.sources.readers import read_model
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/playstats-loaded/{uuid.uuid4().hex}"
    IG.write_tables(_history(spark, sf_dir), f"{root}/loaded")
    loaded = read_model(spark, f"{root}/loaded")
    supplier = fixtures.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("long").alias("_key"), F.col("s_name").alias("name"))
    landed = (DV.landed_lookups(spark, sf_dir).withColumnRenamed("artist_id", "_key").join(supplier, "_key")
              .join(loaded.artists.select("artist_id", "name"), "name").select("artist_id", "body"))
    tables = {k: v for k, v in vars(loaded).items() if v is not None}
    IG.write_tables(EN.enrich_tables(tables, landed), f"{root}/enriched")
    m = read_model(spark, f"{root}/enriched")
    rate = R.genre_match_rate(m).select(F.lit("match_rate").alias("report"), F.lit("artists").alias("item"),
                                        F.col("mb_match").cast("long").alias("value"))
    return rate.unionByName(R.top_genres_by_plays(m, n=20).select(
        F.lit("genre_plays").alias("report"), F.col("genre").alias("item"), F.col("plays").alias("value")))


# ---- layout, clusters, labels, recommendations over the layout
from playstats.operators import clusters as CL  # noqa: E402
from playstats.operators.layout import pca_layout  # noqa: E402


def _layout(spark, sf_dir):
    return pca_layout(FT.feature_matrix(_m(spark, sf_dir)))


@register("layout_pca")
def _q_layout(spark, sf_dir):
    return _layout(spark, sf_dir).select("track_id", "track_name", "artist_name", "x", "y")


@register("density_clusters")
def _q_density(spark, sf_dir):
    return CL.density_clusters(_layout(spark, sf_dir), "x", "y", min_cluster_size=20).select(
        "track_id", "x", "y", "cluster")


@register("cluster_tracks")
def _q_cluster_tracks(spark, sf_dir):
    return RC.cluster_tracks(_m(spark, sf_dir)).drop("features")


@register("cluster_summary")
def _q_cluster_summary(spark, sf_dir):
    return CL.cluster_summary(fixtures.table(spark, sf_dir, "embeddings"), "label")


def behaviour_groups(fm: DataFrame) -> DataFrame:
    """A SQL-expressible segmentation of the feature matrix, used to check the labeller.

    cluster = 4 * (affinity tier index) + (listening pattern index); tracks with a
    high skip rate form the noise group -1.
    """
    aff = (F.when(F.col("affinity_loved") == 1, 0).when(F.col("affinity_liked") == 1, 1)
           .when(F.col("affinity_casual") == 1, 2).otherwise(3))
    pat = (F.when(F.col("pattern_long_term") == 1, 0).when(F.col("pattern_regular") == 1, 1)
           .when(F.col("pattern_occasional") == 1, 2).otherwise(3))
    return fm.withColumn("cluster", F.when(F.col("skip_high") == 1, F.lit(-1))
                         .otherwise(aff * 4 + pat).cast("int"))


@register("label_clusters")
def _q_label_clusters(spark, sf_dir):
    fm = FT.feature_matrix(_m(spark, sf_dir), with_vector=False)
    return CL.label_clusters(behaviour_groups(fm), "cluster")


@register("silhouette")
def _q_silhouette(spark, sf_dir):
    emb = fixtures.table(spark, sf_dir, "embeddings")
    return _rounded(CL.silhouette(emb, "embedding", "label", exclude_noise=True), ["silhouette"], 6)


@register("recommend_by_position")
def _q_rec_position(spark, sf_dir):
    return RC.recommend_by_position(_layout(spark, sf_dir).drop("features"), None, n=5)


@register("recommend_for_random")
def _q_rec_random(spark, sf_dir):
    return RC.recommend_for_random(RC.cluster_tracks(_m(spark, sf_dir)).drop("features"), n=5, seed=42)


# ---- streaming: replay the derived export as drops through ST1 and ST2
@register("stream_monthly_plays")
def _q_stream_monthly(spark, sf_dir):
    import uuid
    from playstats.session import ensure_checkpoint_dir
    from playstats.streaming.plays_stream import stream_monthly_from_export
    run = uuid.uuid4().hex
    work = f"{ensure_checkpoint_dir(spark).rstrip('/')}/playstats-stream/{run}"
    return stream_monthly_from_export(spark, DV.raw_play_export(spark, sf_dir), work)


@register("stream_after_batch_load")
def _q_stream_after_batch(spark, sf_dir):
    """Batch-load a third of the export, stream another, then all of it again: each day is split over the three."""
    import uuid
    from playstats.session import cut_lineage, ensure_checkpoint_dir
    from playstats.sources.readers import read_model
    from playstats.streaming import plays_stream as ST
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/playstats-stream/{uuid.uuid4().hex}"
    raw = cut_lineage(DV.raw_play_export(spark, sf_dir))         # read by the load and by both streams
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]), F.lit(3))
    IG.write_tables(IG.load_play_history(raw.filter(part == 0)), f"{root}/tables")
    for i, rows in enumerate((raw.filter(part == 1), raw)):      # the second sends every day again
        drops = ST.replay_as_drops(rows, f"{root}/{i}")
        ST.ingest_plays_stream(spark, drops, f"{root}/tables", f"{root}/ck{i}", files_per_batch=12).awaitTermination()
    return R.plays_per_month(read_model(spark, f"{root}/tables"))
