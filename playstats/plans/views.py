"""Temp views for SQL users (I20): the model tables and the derived views by name.

After ``register_views(spark, model)`` the report statements can be run with
``spark.sql`` against ``artists``, ``tracks``, ``plays``, ``genres``,
``artist_genres``, ``audio_features``, ``clean_genres``, ``track_features``,
``track_features_engineered`` and ``track_features_clean``. The views are lazy
DataFrames, so Catalyst plans each statement over the same Parquet scans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import SparkSession

from playstats.model import Model
from playstats.plans import features as FT
from playstats.plans import reports as RP


def register_views(spark: SparkSession, m: Model, as_of: _dt.date = FT.DEFAULT_AS_OF,
                   prefix: str = "") -> list[str]:
    views = {
        "artists": m.artists, "tracks": m.tracks, "plays": m.plays, "genres": m.genres,
        "artist_genres": m.artist_genres, "audio_features": m.audio_features,
        "clean_genres": RP.clean_genres(m),
        "track_features": FT.track_features(m),
        "track_features_engineered": FT.track_features_engineered(m, as_of),
        "track_features_clean": FT.track_features_clean(m, as_of),
    }
    names = []
    for name, df in views.items():
        if df is not None:
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
    return names
