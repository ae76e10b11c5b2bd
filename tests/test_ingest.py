import datetime as dt

from pyspark.sql import functions as F

from playstats.operators import ingest as IG
from playstats.sources import readers

from conftest import rows


def test_split_description_edge_cases(spark):
    df = spark.createDataFrame([("A - B",), ("A - B - C",), ("A-B",), ("NoSeparator",), (None,), ("",)],
                               "d string")
    out = dict((r[0], (r[1], r[2])) for r in IG.split_description(df, "d").collect())
    assert out["A - B"] == ("A", "B")
    assert out["A - B - C"] == ("A", "B - C")          # first separator only
    assert out["A-B"] == ("A-B", None)
    assert out["NoSeparator"] == ("NoSeparator", None)
    assert out[None] == (None, None)
    assert out[""] == ("", None)


def test_compact_date_and_lenient_year(spark):
    df = spark.createDataFrame([("20240301",), ("20241301",), (None,)], "d string")
    got = {r[0]: r[1] for r in df.select("d", IG.parse_compact_date("d")).collect()}
    assert got["20240301"] == dt.datetime(2024, 3, 1)
    assert got["20241301"] is None and got[None] is None
    y = spark.createDataFrame([("2012",), ("2012-05",), ("2012-05-04",), ("abc",)], "d string")
    years = {r[0]: r[1] for r in y.select("d", IG.lenient_year("d")).collect()}
    assert years == {"2012": 2012, "2012-05": 2012, "2012-05-04": 2012, "abc": None}


def _write_csv(path, header, lines):
    path.write_text("\n".join([header] + lines) + "\n")


def test_play_history_load_end_to_end(spark, tmp_path):
    # extra and reordered columns: the reader selects by name
    header = "Skip Count,Extra,Track Description,Date Played,Play Duration Milliseconds,Play Count"
    lines = [
        "0,x,Artist A - Song 1,20240301,1000,3",
        "1,x,Artist A - Song 1,20240301,500,1",      # same track and day: keep the smallest
        "0,x,Artist A - Song 2,20240302,2000,2",
        "0,x,Artist B - Song 1,20240301,3000,4",
        "0,x,NoSeparator,20240303,100,1",           # artist without a track
        "0,x,,20240304,100,1",                       # no description: dropped
        "0,x,Artist B - Song 1,20241301,100,1",      # bad date: kept with NULL day
    ]
    p = tmp_path / "plays.csv"
    _write_csv(p, header, lines)
    raw = readers.read_play_history(spark, str(p))
    t = IG.load_play_history(raw)
    assert rows(t["artists"]) == [(1, "Artist A"), (2, "Artist B"), (3, "NoSeparator")]
    assert rows(t["tracks"]) == [(1, "Song 1", 1), (2, "Song 2", 1), (3, "Song 1", 2)]
    plays = rows(t["plays"])
    assert (1, dt.datetime(2024, 3, 1), 500, 1, 1) in plays
    assert len([p for p in plays if p[0] == 1]) == 1
    assert (3, None, 100, 1, 0) in plays
    assert len(plays) == 4
    summary = dict(IG.load_summary(t).collect())
    assert summary == {"artists": 3, "tracks": 3, "plays": 4}


def test_catalog_load_and_audio_match_modes(spark, tmp_path):
    header = ("track_name,track_artist,track_album_name,track_album_release_date,duration_ms,"
              "playlist_genre,playlist_subgenre,danceability,energy,speechiness,acousticness,valence,tempo")
    lines = [
        'Same,Alpha,Alb,2012,1000,pop,dance pop,0.1,0.2,0.3,0.4,0.5,100',
        'Same,Beta,Alb,2012-05,1000,rock,"hard, rock",0.6,0.7,0.8,0.9,0.95,120',
        'Other,Alpha,Alb,abc,1000,pop,electropop,0.2,0.2,0.2,0.2,0.2,90',
        'Missing,Alpha,,2012,1000,pop,pop,0.2,0.2,0.2,0.2,0.2,90',   # no album: dropped
    ]
    p = tmp_path / "cat.csv"
    _write_csv(p, header, lines)
    cat = readers.read_song_catalog(spark, str(p))
    t = IG.load_song_catalog(cat)
    assert rows(t["tracks"], "title", "artist_id", "release_year") == [
        ("Other", 1, None), ("Same", 1, 2012), ("Same", 2, 2012)]
    assert [r[1] for r in rows(t["genres"])] == ["dance pop", "electropop", "hard, rock", "pop", "rock"]
    assert t["audio_features"].count() == 3
    title_only = IG.load_song_catalog(cat, match="title")["audio_features"]
    # The second artist's same-titled track gets no features
    ids = {r[0] for r in title_only.collect()}
    same_beta = t["tracks"].filter((F.col("title") == "Same") & (F.col("artist_id") == 2)).first()[0]
    assert same_beta not in ids and len(ids) == 2


def test_write_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 10, 1, 0)],
                               "track_id long, played_at timestamp_ntz, play_duration_ms long, "
                               "play_count int, skip_count int")
    IG.write_tables({"plays": df}, str(tmp_path))
    back = spark.read.parquet(str(tmp_path / "plays"))
    assert back.count() == 1 and "play_year" in back.columns


def test_headers_in_different_order(spark, tmp_path):
    folder = tmp_path / "exports"
    folder.mkdir()
    (folder / "a.csv").write_text("Track Description,Date Played,Play Duration Milliseconds,Play Count,Skip Count\nA - x,20240301,1000,2,0\n")
    (folder / "b.csv").write_text("Skip Count,Play Count,Date Played,Extra,Track Description,Play Duration Milliseconds\n7,9,20240302,z,B - y,500\n")
    got = rows(readers.read_play_history(spark, str(folder)))
    assert got == [("A - x", "20240301", 1000, 2, 0), ("B - y", "20240302", 500, 9, 7)]


def test_days_do_not_depend_on_the_time_zone(spark):
    from playstats.functions.exprs import month_name_padded, month_start, year_month
    df = spark.createDataFrame([("20181104",), ("20171001",), ("20241301",), ("x",), (None,)], "d string")
    before = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for zone in ("UTC", "America/Sao_Paulo", "America/Asuncion"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            out = df.select(IG.parse_compact_date("d").alias("t")).select(
                F.col("t").cast("string"), month_start("t").cast("string"), month_name_padded("t"), year_month("t"))
            seen.add(tuple(map(tuple, out.collect())))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    (only,) = seen
    assert only[0] == ("2018-11-04 00:00:00", "2018-11-01 00:00:00", "November ", "2018-11") and only[3] == (None,) * 4


def test_catalog_reader_quoted_multiline_and_bad_numbers(spark, tmp_path):
    header = ("extra,track_name,track_artist,track_album_name,track_album_release_date,duration_ms,"
              "playlist_genre,playlist_subgenre,danceability,energy,speechiness,acousticness,valence,tempo")
    body = ('x,"Line one\nline two",Alpha,"Alb, ""deluxe""",2012,1000,pop,pop,0.1,0.2,0.3,0.4,0.5,100\n'
            'x,Plain,Beta,Alb,2012,notanumber,rock,rock,0.1,0.2,0.3,0.4,0.5,100\n')
    p = tmp_path / "cat.csv"
    p.write_text(header + "\n" + body)
    cat = readers.read_song_catalog(spark, str(p), multi_line=True)
    got = {r.track_artist: (r.track_name, r.track_album_name, r.duration_ms) for r in cat.collect()}
    assert got["Alpha"] == ("Line one\nline two", 'Alb, "deluxe"', 1000)
    assert got["Beta"] == ("Plain", "Alb", None)      # malformed number -> NULL, row kept


def test_load_write_read_report_round_trip(spark, tmp_path):
    from playstats.plans import reports as R
    header = "Track Description,Date Played,Play Duration Milliseconds,Play Count,Skip Count"
    lines = [f"Artist {a} - Song {s},202{y}0{m}0{d},1000,{1 + (a + s) % 3},{(a * s) % 2}"
             for a in range(3) for s in range(4) for y in (3, 4) for m in (1, 2) for d in (1, 2)]
    p = tmp_path / "plays.csv"
    _write_csv(p, header, lines)
    root = str(tmp_path / "model")
    from playstats import cli
    cli.main(["load-history", str(p), root])
    m = readers.read_model(spark, root)
    assert m.audio_features is None and "play_year" in m.plays.columns
    got = {r.name: r.plays for r in R.top_artists(m).collect()}
    expect = {}
    for a in range(3):
        expect[f"Artist {a}"] = sum(1 + (a + s) % 3 for s in range(4)) * 8
    assert got == expect
    by_year = {r.listen_year: r.yearly_listening_min for r in R.listening_minutes_by_year(m).collect()}
    assert by_year == {2023: 48 * 1000 // 60000, 2024: 48 * 1000 // 60000}


def test_many_files_with_different_headers(spark, tmp_path):
    """More than a thousand files, some in subfolders, with two orders of columns, empty and blank-led files."""
    from playstats.sources.readers import read_play_history
    one = "Track Description,Date Played,Play Duration Milliseconds,Play Count,Skip Count"
    two = "Play Count,extra,Skip Count,Track Description,Date Played,Play Duration Milliseconds"
    for i in range(1030):
        folder = tmp_path / f"part{i % 3}"
        folder.mkdir(exist_ok=True)
        body = f"{one}\nA - t{i},20200101,{i},1,0\n" if i % 2 else f"{two}\n1,x,0,A - t{i},20200101,{i}\n"
        (folder / f"drop {i}.csv").write_text(("\n" if i == 7 else "") + body)
    (tmp_path / "part0" / "empty.csv").write_text("")
    (tmp_path / "part0" / "blank.csv").write_text("\n\n")
    (tmp_path / "part0" / "_partial.csv").write_text(f"{one}\nA - no,20200101,1,1,0\n")
    got = read_play_history(spark, str(tmp_path))
    rows = {r["Track Description"]: (r["Play Duration Milliseconds"], r["Play Count"]) for r in got.collect()}
    assert rows == {f"A - t{i}": (i, 1) for i in range(1030)}
    same = tmp_path / "same"
    same.mkdir()
    for i in range(5):
        (same / f"{i}.csv").write_text(f"{one}\nA - t{i},20200101,{i},1,0\n")
    assert read_play_history(spark, str(same)).count() == 5


def test_plays_are_shuffled_without_their_names(spark, monkeypatch):
    rows = [("A - x", "20200101", 5, 1, 0), ("A - x", "20200101", 3, 2, 0), ("A - y", "20200102", 7, 1, 1), ("B - x", "junk", 1, 1, 0),
            ("B", "20200101", 1, 1, 0), (None, "20200101", 1, 1, 0), (" - x", "20200103", 4, 1, 0), ("B - x - y", "20200104", 2, 1, 0), ("B - ", "20200104", 9, 1, 0)]
    raw = spark.createDataFrame(rows, "`Track Description` string, `Date Played` string, `Play Duration Milliseconds` long, `Play Count` int, `Skip Count` int")

    def named(t):
        full = t["plays"].join(t["tracks"], "track_id").join(t["artists"], "artist_id")
        return sorted((r["name"], r["title"], str(r["played_at"]), r["play_duration_ms"], r["play_count"]) for r in full.collect())

    monkeypatch.setattr(IG, "cut_lineage", lambda df: df.localCheckpoint())      # plans without file names
    loaded = IG.load_play_history(raw)
    exchanges = [x for x in loaded["plays"]._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x or "SortMergeJoin" in x]
    assert exchanges and not any("track_name" in x or "artist_name" in x for x in exchanges)
    want = [("", "x", "2020-01-03 00:00:00", 4, 1), ("A", "x", "2020-01-01 00:00:00", 3, 2), ("A", "y", "2020-01-02 00:00:00", 7, 1),
            ("B", "", "2020-01-04 00:00:00", 9, 1), ("B", "x", "None", 1, 1), ("B", "x - y", "2020-01-04 00:00:00", 2, 1)]
    assert named(loaded) == want
    monkeypatch.setattr(IG, "pair_key", lambda: F.lit(1).cast("long"))           # tracks that share a key
    assert named(IG.load_play_history(raw)) == want


def test_raw_export_is_read_once(spark):
    rows = [("A - x", "20200101", 5, 1, 0), ("A - x", "20200101", 3, 2, 0), ("B", "20200101", 1, 1, 0), ("B - y", "junk", 1, 1, 0)]
    seen = spark.sparkContext.accumulator(0)

    def count(row):
        seen.add(1)
        return row

    raw = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(count), "`Track Description` string, `Date Played` string, "
                                "`Play Duration Milliseconds` long, `Play Count` int, `Skip Count` int")
    loaded = IG.load_play_history(raw)
    assert {name: df.count() for name, df in loaded.items()} == {"artists": 2, "tracks": 2, "plays": 2}
    assert seen.value == len(rows)


def test_compact_date_is_the_parsers(spark):
    texts = ["20240301", "20240230", "00010101", "00000101", "99991231", "+120240101", "-20240101", "2024x", "20240301 ", " 20240301",
             "20240301\n", "2024031", "202403011", "", None, "+20240101", "unknown", "2024-03-01", "20241301", "２０２４０３０１"]
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    both = df.select(IG.parse_compact_date("d").cast("string"),
                     F.try_to_date("d", "yyyyMMdd").cast("timestamp_ntz").cast("string")).collect()
    assert [r[0] for r in both] == [r[1] for r in both] and sum(r[0] is not None for r in both) == 6
