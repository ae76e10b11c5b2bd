"""The normalised music model carried between operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Model:
    """The six populated tables of the schema.

    artists(artist_id long, name string, mbid string, country string)
    tracks(track_id long, title string, artist_id long, album string,
           release_year int, duration_ms int)
    plays(track_id long, played_at timestamp_ntz, play_duration_ms long,
          play_count int, skip_count int)       -- one row per track per day
    genres(genre_id long, name string)
    artist_genres(artist_id long, genre_id long)
    audio_features(track_id long, tempo, energy, valence, acousticness,
                   speechiness, danceability double)
    """

    artists: DataFrame
    tracks: DataFrame
    plays: DataFrame
    genres: DataFrame
    artist_genres: DataFrame
    audio_features: DataFrame
