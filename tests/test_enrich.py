from playstats.operators import enrich as EN
from playstats.sources import readers

from conftest import rows


def _landed(spark, tmp_path):
    lines = [
        '{"artist_id": 1, "body": "{\\"artists\\": []}"}',
        '{"artist_id": 2, "body": "{\\"artists\\": [{\\"id\\": \\"m2\\"}]}"}',
        '{"artist_id": 3, "body": "{\\"artists\\": [{\\"id\\": \\"m3\\", \\"country\\": \\"IE\\", '
        '\\"tags\\": [{\\"name\\": \\"pop\\"}, {\\"name\\": \\"folk\\"}, {\\"name\\": \\"pop\\"}]}, '
        '{\\"id\\": \\"second\\"}]}"}',
        '{"artist_id": 4, "body": "{\\"artists\\": ["}',
        '{"artist_id": 5, "body": null}',
    ]
    p = tmp_path / "lookups.json"
    p.write_text("\n".join(lines) + "\n")
    return readers.read_lookup_responses(spark, str(p))


def test_parse_lookup_cases(spark, tmp_path):
    got = {r.artist_id: (r.mbid, list(r.tags), r.country, r.status)
           for r in EN.parse_lookup(_landed(spark, tmp_path)).collect()}
    assert got[1] == (None, [], None, "no_match")
    assert got[2] == ("m2", [], None, "ok")                       # no tags, no country
    assert got[3] == ("m3", ["pop", "folk", "pop"], "IE", "ok")   # first hit only
    assert got[4] == (None, [], None, "error")                    # malformed JSON
    assert got[5] == (None, [], None, "error")                    # failed fetch


def test_resume_update_and_genres(spark, tmp_path):
    lk = EN.parse_lookup(_landed(spark, tmp_path))
    artists = spark.createDataFrame([(i, f"A{i}", "old", "XX") for i in range(1, 7)],
                                    "artist_id long, name string, mbid string, country string")
    assert [r[0] for r in rows(EN.pending_artists(artists, lk), "artist_id")] == [4, 5, 6]
    upd = {r.artist_id: (r.mbid, r.country) for r in EN.apply_enrichment(artists, lk).collect()}
    assert upd[1] == (None, None)          # processed with no result: NULLs written
    assert upd[3] == ("m3", "IE")
    assert upd[4] == ("old", "XX") and upd[6] == ("old", "XX")
    g = EN.explode_tags(lk)
    assert rows(g) == [(1, "folk"), (2, "pop")]
    assert rows(EN.tag_bridge(lk, g)) == [(3, 1), (3, 2)]   # duplicate tag collapsed


def test_checkpoint_append_resumes(spark, tmp_path):
    lk = EN.parse_lookup(_landed(spark, tmp_path))
    path = str(tmp_path / "results")
    EN.append_checkpoint(lk.filter("artist_id <= 2"), path)
    EN.append_checkpoint(lk.filter("artist_id > 2"), path)
    back = spark.read.parquet(path)
    assert back.count() == 5


def test_latest_lookup_wins_and_columns_are_added(spark):
    lk = spark.createDataFrame([(1, "m1", ["a"], "IE", "ok", 1), (1, "m2", ["b"], None, "ok", 2), (1, None, [], None, "error", 3)],
                               "artist_id long, mbid string, tags array<string>, country string, status string, batch int")
    artists = spark.createDataFrame([(1, "A"), (2, "B")], "artist_id long, name string")
    assert rows(EN.apply_enrichment(artists, lk)) == [(1, "A", "m2", None), (2, "B", None, None)]
    assert rows(EN.explode_tags(lk)) == [(1, "b")]


def test_enriched_tables_keep_known_genres(spark, tmp_path):
    tables = {"artists": spark.createDataFrame([(3, "C")], "artist_id long, name string"),
              "genres": spark.createDataFrame([(7, "pop")], "genre_id long, name string"),
              "artist_genres": spark.createDataFrame([(3, 7)], "artist_id long, genre_id long")}
    out = EN.enrich_tables(tables, _landed(spark, tmp_path))
    assert rows(out["genres"]) == [(7, "pop"), (8, "folk")]
    assert rows(out["artist_genres"]) == [(3, 7), (3, 8)]
    assert rows(out["artists"]) == [(3, "C", "m3", "IE")]
