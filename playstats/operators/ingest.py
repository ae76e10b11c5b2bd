"""Ingest operators: raw exports -> normalised model tables.

Every step is a DataFrame transformation. Surrogate ids come from
:func:`dense_index` (ordered by the natural key, so reruns give the same ids) and
"keep first" de-duplication picks the smallest remaining columns with a
``min(struct(...))`` aggregate, which combines map-side (sort-based, as struct
buffers are not hash-aggregatable) and never sorts a whole hot group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playstats.operators.ranking import dense_index, global_row_number
from playstats.session import cut_lineage

DESCRIPTION_SEPARATOR = " - "


# ----------------------------------------------------------------- row-level steps
def drop_null_rows(df: DataFrame, cols) -> DataFrame:
    """I4: drop rows with a NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def split_description(df: DataFrame, col: str = "Track Description",
                      sep: str = DESCRIPTION_SEPARATOR,
                      first: str = "artist_name", second: str = "track_name") -> DataFrame:
    """Split at the first separator only.

    No separator: ``first`` = whole text, ``second`` = NULL. The separator is searched once, as plain text, without a
    regular expression a row.
    """
    text = F.col(col)
    before = df.withColumn(first, F.substring_index(text, sep, 1))       # the whole text if there is no separator
    at = F.length(first)
    return before.withColumn(second, F.when(F.octet_length(first) < F.octet_length(text),
                                            F.substring(text, at + len(sep) + 1, F.length(text))))


def parse_compact_date(c) -> Column:
    """``yyyyMMdd`` text -> timestamp_ntz; unparsable -> NULL.

    Parsed as a date, never as a zoned timestamp: a midnight that a zone skips would move.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    plain = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)).try_cast("date")
    # Eight digits are cast; the pattern's parser raises an error inside for each text it refuses, and
    # takes nothing else but years with a sign.
    return (F.when(text.rlike(r"^[0-9]{8}\z"), plain)
            .when(text.rlike("^[+-]"), F.try_to_date(text, "yyyyMMdd")).cast("timestamp_ntz"))


def lenient_year(c) -> Column:
    """Year of a date of any precision ('2012', '2012-05', '2012-05-04'); junk -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.year(col.try_cast("date"))


def keep_first(df: DataFrame, key_cols, order_cols, payload_cols=None) -> DataFrame:
    """One row per key, the one with the smallest ``order_cols`` (then payload)."""
    payload = [c for c in (payload_cols or df.columns) if c not in key_cols and c not in order_cols]
    first = F.min(F.struct(*order_cols, *payload)).alias("_first")
    return (df.groupBy(*key_cols).agg(first)
            .select(*key_cols, *[F.col(f"_first.{c}").alias(c) for c in [*order_cols, *payload]]))


def dim_with_surrogate_key(df: DataFrame, natural_cols, id_name: str) -> DataFrame:
    """Distinct natural keys numbered 1..n in key order."""
    return dense_index(df.select(*natural_cols).dropna(how="all"), list(natural_cols), id_name)


# ----------------------------------------------------------- play-history loader
def prepare_play_export(raw: DataFrame) -> DataFrame:
    """I4 + I5 + I6: drop rows without description, split it, rename columns."""
    df = split_description(drop_null_rows(raw, ["Track Description"]))
    return df.select("artist_name", "track_name",
                     F.col("Date Played").alias("played_at_text"),
                     F.col("Play Duration Milliseconds").alias("play_duration_ms"),
                     F.col("Play Count").alias("play_count"),
                     F.col("Skip Count").alias("skip_count"))


def build_artists(prepared: DataFrame) -> DataFrame:
    """Artists of the play export: (artist_id, name), ids by name order."""
    a = dim_with_surrogate_key(prepared.select(F.col("artist_name").alias("name")), ["name"],
                               "artist_id")
    return a.select("artist_id", "name")


def build_tracks(prepared: DataFrame, artists: DataFrame) -> DataFrame:
    """I8: distinct (title, artist) resolved to artist_id; NULL titles dropped, then numbered."""
    pairs = (prepared.select(F.col("track_name").alias("title"), "artist_name").distinct()
             .join(artists.select("artist_id", F.col("name").alias("artist_name")), "artist_name")
             .filter(F.col("title").isNotNull()))
    numbered = dense_index(pairs, ["artist_id", "title"], "track_id")
    return numbered.select("track_id", "title", "artist_id")


def dedupe_daily_plays(plays: DataFrame, order_cols=("play_duration_ms", "play_count",
                                                      "skip_count")) -> DataFrame:
    """I11 on plays: one row per (track_id, played_at)."""
    return keep_first(plays, ["track_id", "played_at"], list(order_cols))


PLAY_VALUES = ("play_duration_ms", "play_count", "skip_count")


def merge_versions(plays: DataFrame) -> DataFrame:
    """One row per track and day of a plays table to which a stream appended corrections.

    ``change`` is -1 for a row that takes a stored one back, else 1 or null. Of a day's versions the smallest
    stands, which is the row the batch loader keeps of the same rows. The year is a key, so that year
    filters still prune folders.
    """
    standing = plays.filter(F.coalesce("change", F.lit(1)) == 1).drop("change")
    return keep_first(standing, ["track_id", "played_at", "play_year"], list(PLAY_VALUES)).select(*standing.columns)


def pair_key() -> Column:
    """64 bits of (track_name, artist_name)."""
    return F.xxhash64("track_name", "artist_name")


def keyed_export(prepared: DataFrame) -> DataFrame:
    """The prepared export with its days parsed and ``pair``, the :func:`pair_key` of rows that have both names.

    Stored, it is read twice: the names for artists and tracks, the key and the values for the plays.
    """
    named = F.col("track_name").isNotNull() & F.col("artist_name").isNotNull()
    return prepared.select("artist_name", "track_name", F.when(named, pair_key()).alias("pair"),
                           parse_compact_date("played_at_text").alias("played_at"), *PLAY_VALUES)


def resolve_plays(keyed: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """The rows of a :func:`keyed_export` with the ids of their tracks.

    The plays meet their tracks by :func:`pair_key`, so they are shuffled without their names. If two tracks
    share a key, the names themselves are joined.
    """
    ids = cut_lineage(tracks.join(artists.select("artist_id", "name"), "artist_id").select(
        "track_id", F.col("title").alias("track_name"), F.col("name").alias("artist_name")).withColumn("pair", pair_key()))
    shared = ids.groupBy("pair").count().filter("count > 1").limit(1).count()
    by = ["track_name", "artist_name"] if shared else ["pair"]
    plays = keyed.filter(F.col("pair").isNotNull()).select(*by, "played_at", *PLAY_VALUES)
    return plays.join(ids.select(*by, "track_id"), by).select("track_id", "played_at", *PLAY_VALUES)


def build_plays(keyed: DataFrame, tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Join back on (title, artist name), one row per track and day."""
    return dedupe_daily_plays(resolve_plays(keyed, tracks, artists)).select("track_id", "played_at", *PLAY_VALUES)


def load_play_history(raw: DataFrame) -> dict[str, DataFrame]:
    """The whole play-history load: artists, tracks, plays.

    The raw export is read once and written, split and keyed, to the shared checkpoint folder; so are its
    distinct (artist, title) pairs, from which both artists and tracks come.
    """
    keyed = cut_lineage(keyed_export(prepare_play_export(raw)))
    pairs = cut_lineage(keyed.select("artist_name", "track_name").distinct())
    artists = build_artists(pairs)
    tracks = build_tracks(pairs, artists)
    return {"artists": artists, "tracks": tracks, "plays": build_plays(keyed, tracks, artists)}


# -------------------------------------------------------------- catalog loader
def prepare_catalog(raw: DataFrame) -> DataFrame:
    """Drop catalog rows missing title, artist or album (I4)."""
    return drop_null_rows(raw, ["track_name", "track_artist", "track_album_name"])


def build_catalog_artists(cat: DataFrame) -> DataFrame:
    a = dim_with_surrogate_key(cat.select(F.col("track_artist").alias("name")), ["name"], "artist_id")
    return a.select("artist_id", "name")


def build_catalog_tracks(cat: DataFrame, artists: DataFrame) -> DataFrame:
    """Tracks of the catalog: first row per (title, artist), lenient release year."""
    first = keep_first(cat.select("track_name", "track_artist", "track_album_name",
                                  "track_album_release_date", "duration_ms"),
                       ["track_name", "track_artist"],
                       ["track_album_name", "track_album_release_date", "duration_ms"])
    j = first.join(artists.select("artist_id", F.col("name").alias("track_artist")), "track_artist")
    # (artist, title) is unique after keep_first, so the rows themselves are numbered
    numbered = global_row_number(j.withColumnRenamed("track_name", "title"),
                                 [("artist_id", True), ("title", True)], "track_id", nulls_first=False)
    return numbered.select("track_id", "title", "artist_id", F.col("track_album_name").alias("album"),
                           lenient_year("track_album_release_date").alias("release_year"), "duration_ms")


def build_genres(cat: DataFrame) -> DataFrame:
    """Union of both genre columns, distinct, numbered by name."""
    names = (cat.select(F.col("playlist_genre").alias("name"))
             .unionByName(cat.select(F.col("playlist_subgenre").alias("name"))))
    g = dim_with_surrogate_key(names.dropna(), ["name"], "genre_id")
    return g.select("genre_id", "name")


def build_artist_genres(cat: DataFrame, artists: DataFrame, genres: DataFrame) -> DataFrame:
    """Distinct (artist, main genre) pairs resolved to ids."""
    pairs = cat.select(F.col("track_artist").alias("name"),
                       F.col("playlist_genre").alias("genre")).distinct()
    return (pairs.join(artists.select("artist_id", "name"), "name")
            .join(genres.select("genre_id", F.col("name").alias("genre")), "genre")
            .select("artist_id", "genre_id").distinct())


AUDIO_COLS = ("danceability", "energy", "speechiness", "acousticness", "valence", "tempo")


def build_audio_features(cat: DataFrame, tracks: DataFrame, artists: DataFrame,
                         match: str = "title_artist") -> DataFrame:
    """Audio features per track.

    ``match="title_artist"`` joins on title and artist. ``match="title"`` keeps the
    reference's behaviour (D8): catalog rows join the *first* track with that title
    (lowest track_id), then one row per track_id is kept, so a second artist's
    same-titled track gets no features.
    """
    first = keep_first(cat.select("track_name", "track_artist", *AUDIO_COLS),
                       ["track_name", "track_artist"], list(AUDIO_COLS))
    if match == "title_artist":
        keyed = tracks.join(artists.select("artist_id", F.col("name").alias("track_artist")),
                            "artist_id").select("track_id", F.col("title").alias("track_name"),
                                                "track_artist")
        j = first.join(keyed, ["track_name", "track_artist"])
        return j.select("track_id", *AUDIO_COLS)
    if match != "title":
        raise ValueError(match)
    first_track = (tracks.groupBy(F.col("title").alias("track_name"))
                   .agg(F.min("track_id").alias("track_id")))
    j = first.join(first_track, "track_name")
    one = keep_first(j.select("track_id", "track_artist", *AUDIO_COLS), ["track_id"],
                     ["track_artist"], list(AUDIO_COLS))
    return one.select("track_id", *AUDIO_COLS)


def load_song_catalog(raw: DataFrame, match: str = "title_artist") -> dict[str, DataFrame]:
    """The whole catalog load: artists, tracks, genres, artist_genres, audio_features.

    The cleaned catalog feeds five tables, so it is written once to the shared
    checkpoint folder instead of being re-read and re-parsed for each.
    """
    cat = cut_lineage(prepare_catalog(raw))
    artists = build_catalog_artists(cat)
    tracks = build_catalog_tracks(cat, artists)
    genres = build_genres(cat)
    return {"artists": artists, "tracks": tracks, "genres": genres,
            "artist_genres": build_artist_genres(cat, artists, genres),
            "audio_features": build_audio_features(cat, tracks, artists, match)}


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per loaded table, one small union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                   "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Columns that a table has in the schema even where its loader does not know them.
FULL_SCHEMA = {"artists": {"mbid": "string", "country": "string"},
               "tracks": {"album": "string", "release_year": "int", "duration_ms": "int"}}


def full_schema(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with every column of the schema, NULL where nothing is known yet."""
    return {name: df.withColumns({c: F.lit(None).cast(t) for c, t in FULL_SCHEMA.get(name, {}).items()
                                  if c not in df.columns}) for name, df in tables.items()}


def write_tables(tables: dict[str, DataFrame], root: str, mode: str = "overwrite",
                 fmt: str = "parquet") -> None:
    """Full refresh (overwrite) or append; plays partitioned by play year.

    The one writer of model tables, for the batch loaders and for the stream.
    """
    for name, df in full_schema(tables).items():
        w = df.write.mode(mode).format(fmt)
        if name == "plays" and "played_at" in df.columns:
            df = df.withColumn("play_year", F.year("played_at"))
            w = df.write.mode(mode).format(fmt).partitionBy("play_year")
        w.save(f"{root.rstrip('/')}/{name}")
