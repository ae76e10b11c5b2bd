"""Artist enrichment from landed lookup responses.

The HTTP loop of the reference is replaced by responses landed as data
(artist_id, body); Spark parses, resumes, updates and derives genres from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playstats.operators.ranking import dense_index

# The part of a lookup response that is read.
LOOKUP_SCHEMA = T.StructType([
    T.StructField("artists", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))),
    ]))),
])

STATUS_OK, STATUS_NO_MATCH, STATUS_ERROR = "ok", "no_match", "error"
BATCH = "batch"          # optional: number of the append that wrote a lookup
_BAD = "_corrupt"


def parse_lookup(landed: DataFrame) -> DataFrame:
    """(artist_id, body) -> (artist_id, mbid, tags, country, status).

    First hit only; no hits -> NULL, [], NULL with status 'no_match'; a body that is
    not valid JSON (or a failed fetch with no body) -> status 'error', same empty
    values (the reference stores failures like empty results; the status lets a
    later run retry exactly those).
    """
    # One parse: a body that is not JSON leaves its text in the corrupt-record field.
    schema = T.StructType([*LOOKUP_SCHEMA.fields, T.StructField(_BAD, T.StringType())])
    parsed = landed.withColumn("_j", F.from_json("body", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}))
    valid = F.col("body").isNotNull() & F.col(f"_j.{_BAD}").isNull() & (F.trim("body") != "")
    hit = F.get(F.col("_j.artists"), 0)
    tags = F.coalesce(F.transform(hit.getField("tags"), lambda t: t.getField("name")),
                      F.array().cast("array<string>"))
    return parsed.select(
        F.col("artist_id").cast("long").alias("artist_id"),
        F.when(valid, hit.getField("id")).alias("mbid"),
        F.when(valid, tags).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.when(valid, hit.getField("country")).alias("country"),
        F.when(~valid, F.lit(STATUS_ERROR))
        .when(hit.isNull(), F.lit(STATUS_NO_MATCH)).otherwise(F.lit(STATUS_OK)).alias("status"),
        *[F.col(c) for c in landed.columns if c == BATCH])


def processed(lookups: DataFrame) -> DataFrame:
    """One lookup an artist that counts as done (errors are retried, D12).

    Of several, the one of the latest batch; without a batch column, or within one batch,
    the largest (mbid, country, tags), so reruns agree.
    """
    done = lookups.filter(F.col("status") != STATUS_ERROR)
    batch = F.col(BATCH).cast("long") if BATCH in lookups.columns else F.lit(0).cast("long")
    last = F.max(F.struct(batch.alias("b"), "mbid", "country", "tags", "status")).alias("_last")
    return done.groupBy("artist_id").agg(last).select(
        "artist_id", "_last.mbid", "_last.tags", "_last.country", "_last.status")


def pending_artists(artists: DataFrame, lookups: DataFrame) -> DataFrame:
    """Artists still to fetch = no successful lookup yet (resume)."""
    done = processed(lookups).select("artist_id").distinct()
    return artists.join(done, "artist_id", "left_anti")


def append_checkpoint(batch: DataFrame, path: str, number: int | None = None) -> None:
    """Append one processed batch to the lookup-results table (the resume state).

    ``number`` orders the appends; a later lookup of an artist replaces an earlier one.
    """
    out = batch if number is None else batch.withColumn(BATCH, F.lit(number).cast("long"))
    out.write.mode("append").parquet(path)


def apply_enrichment(artists: DataFrame, lookups: DataFrame) -> DataFrame:
    """E5: UPDATE artists SET mbid, country for every processed id (NULLs included).

    Both columns are always in the result, NULL where nothing is known.
    """
    done = processed(lookups).select("artist_id", F.col("mbid").alias("_mbid"),
                                     F.col("country").alias("_country"), F.lit(True).alias("_hit"))
    none = F.lit(None).cast("string")
    have = {c: F.col(c) if c in artists.columns else none for c in ("mbid", "country")}
    j = artists.join(done, "artist_id", "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    new = {c: F.when(hit, F.col(f"_{c}")).otherwise(have[c]).alias(c) for c in have}
    return j.select(*[new.get(c, F.col(c)) for c in artists.columns],
                    *[new[c] for c in new if c not in artists.columns])


def enrich_tables(tables: dict[str, DataFrame], landed: DataFrame) -> dict[str, DataFrame]:
    """The enrichment run over loaded tables: artists updated, genres and bridge from the tags.

    Names that ``genres`` holds already keep their ids, new ones are numbered after them.
    """
    lookups = parse_lookup(landed)
    genres, bridge = tables.get("genres"), tables.get("artist_genres")
    tags = explode_tags(lookups)
    if genres is not None:
        last = genres.agg(F.coalesce(F.max("genre_id"), F.lit(0)).alias("_last"))   # one row
        fresh = dense_index(tags.join(genres.select("name"), "name", "left_anti"), ["name"], "_n")
        tags = genres.select("genre_id", "name").unionByName(
            fresh.crossJoin(F.broadcast(last)).select((F.col("_last") + F.col("_n")).alias("genre_id"), "name"))
    pairs = tag_bridge(lookups, tags)
    if bridge is not None:
        pairs = bridge.select("artist_id", "genre_id").unionByName(pairs).distinct()
    return {**tables, "artists": apply_enrichment(tables["artists"], lookups), "genres": tags,
            "artist_genres": pairs}


def explode_tags(lookups: DataFrame) -> DataFrame:
    """Distinct tag names numbered as genres (ids by name order)."""
    names = processed(lookups).select(F.explode("tags").alias("name")).dropna()
    return dense_index(names, ["name"], "genre_id").select("genre_id", "name")


def tag_bridge(lookups: DataFrame, genres: DataFrame) -> DataFrame:
    """(artist_id, genre_id) for every tag of every processed artist, deduplicated."""
    pairs = processed(lookups).select("artist_id", F.explode("tags").alias("name")).distinct()
    return pairs.join(genres.select("genre_id", "name"), "name").select("artist_id", "genre_id").distinct()
