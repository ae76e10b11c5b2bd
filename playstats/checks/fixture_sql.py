"""The fixture views of FIXTURES.md as DuckDB CTEs.

The correctness driver registers only the base tables, so every oracle query is
this prefix followed by its own SELECT.
"""

FIXTURE_CTES = """WITH
m_artists AS (
  SELECT s_suppkey AS artist_id, s_name AS name,
         CASE WHEN s_acctbal >= 1000 THEN 'mb-' || s_suppkey END AS mbid,
         n_name AS country
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
m_tracks AS (
  SELECT p_partkey AS track_id, p_name AS title,
         p_partkey % (SELECT COUNT(*) FROM supplier) AS artist_id, p_brand AS album,
         CASE WHEN p_size % 10 <> 0 THEN 1960 + p_size END AS release_year,
         CASE WHEN p_size % 7 <> 0 THEN CAST(ROUND(p_retailprice * 200) AS INT) END AS duration_ms
  FROM part),
m_plays_raw AS (
  SELECT l_partkey AS track_id, CASE WHEN l_partkey % 30 = 2 THEN TIMESTAMP '1998-06-01'
              WHEN l_partkey % 6 = 0 THEN CAST(date_trunc('year', l_shipdate) AS TIMESTAMP)
              WHEN l_partkey % 6 = 1 THEN CAST(date_trunc('quarter', l_shipdate) AS TIMESTAMP)
              ELSE CAST(l_shipdate AS TIMESTAMP) END AS played_at,
         CAST(l_extendedprice * 3 AS BIGINT) AS play_duration_ms,
         CASE WHEN CAST(l_quantity AS INT) <= l_partkey % 50 THEN 1 + CAST(l_quantity AS INT) % 5 ELSE 0 END AS play_count,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS INT) % 4 ELSE 0 END AS skip_count,
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  FROM lineitem),
m_plays AS (
  SELECT track_id, played_at, play_duration_ms, play_count, skip_count
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY track_id, played_at
                  ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) rn
        FROM m_plays_raw) z
  WHERE rn = 1),
m_genres AS (
  SELECT ROW_NUMBER() OVER (ORDER BY name) AS genre_id, name
  FROM (SELECT p_type AS name FROM part UNION SELECT p_brand FROM part
        UNION SELECT o_orderpriority FROM orders UNION SELECT lang FROM documents) u),
m_artist_genres AS (
  SELECT DISTINCT artist_id, genre_id
  FROM (SELECT p_partkey % (SELECT COUNT(*) FROM supplier) AS artist_id,
               CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_type END AS name
        FROM part
        UNION
        SELECT o_custkey % (SELECT COUNT(*) FROM supplier), o_orderpriority
        FROM orders) x
  JOIN m_genres USING (name)),
m_audio_features AS (
  SELECT p_partkey AS track_id, 60 + p_size * 2.5 AS tempo,
         (p_partkey * 37 % 101) / 100.0 AS energy, (p_partkey * 53 % 101) / 100.0 AS valence,
         (p_partkey * 71 % 101) / 100.0 AS acousticness, (p_partkey * 11 % 101) / 100.0 AS speechiness,
         p_size / 50.0 AS danceability
  FROM part),
m_clean_genres AS (
  SELECT genre_id, name FROM m_genres
  WHERE ascii(left(name, 1)) BETWEEN 65 AND 122
    AND ascii(left(name, 1)) NOT BETWEEN 91 AND 96
    AND length(name) < 40 AND length(name) > 2)
"""


def with_fixtures(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the fixture CTEs (plus optional further CTEs)."""
    ctes = FIXTURE_CTES.rstrip()
    if extra_ctes:
        ctes += ",\n" + extra_ctes.strip().rstrip(",")
    return ctes + "\n" + body.strip()
