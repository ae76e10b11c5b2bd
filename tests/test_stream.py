import datetime as dt

from pyspark.sql import functions as F

from playstats.plans import reports as R
from playstats.model import Model
from playstats.streaming import plays_stream as ST

HEADER = "Track Description,Date Played,Play Duration Milliseconds,Play Count,Skip Count"


def _drop(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([HEADER] + lines) + "\n")


def test_stream_ingest_is_idempotent_and_monthly_matches_batch(spark, tmp_path):
    src, tables, ck = tmp_path / "drops", tmp_path / "tables", tmp_path / "ck"
    _drop(src, "day1.csv", ["A - x,20240301,1000,2,0", "A - x,20240301,900,1,1",
                            "B - y,20240302,500,1,0"])
    ST.ingest_plays_stream(spark, str(src), str(tables), str(ck / "ingest")).awaitTermination()
    # second drop: one day already loaded (re-sent), one new day, one new artist
    _drop(src, "day2.csv", ["A - x,20240301,1000,2,0", "A - x,20240402,100,3,0", "B - y,2024x,1,1,0",
                            "C - z,20240402,100,1,0"])
    ST.ingest_plays_stream(spark, str(src), str(tables), str(ck / "ingest")).awaitTermination()
    artists = {r.name: r.artist_id for r in spark.read.parquet(str(tables / "artists")).collect()}
    assert artists == {"A": 1, "B": 2, "C": 3}
    plays = spark.read.parquet(str(tables / "plays"))
    assert plays.count() == 5          # 4 days + one unparsable day
    assert plays.groupBy("track_id", "played_at").count().filter("count > 1").count() == 0
    first = plays.filter(F.col("played_at") == dt.datetime(2024, 3, 1)).first()
    assert (first.play_duration_ms, first.play_count) == (900, 1)

    _drop(src, "day3.csv", ["B - y,2024x,1,1,0"])   # the unparsable day again: not re-added
    ST.ingest_plays_stream(spark, str(src), str(tables), str(ck / "ingest")).awaitTermination()
    plays = spark.read.parquet(str(tables / "plays"))
    assert plays.count() == 5
    q = ST.monthly_plays_stream(spark, str(tables / "plays"), str(ck / "monthly"), "monthly_t")
    q.awaitTermination()
    key = lambda t: tuple(str(x) for x in t)
    streamed = sorted((tuple(r) for r in spark.sql("SELECT * FROM monthly_t").collect()), key=key)
    m = Model(None, None, plays, None, None, None)
    batch = sorted((tuple(r) for r in R.plays_per_month(m).collect()), key=key)
    assert streamed == batch
    assert [t for t in batch if t[2] is not None] == [(2, "March    ", "2024-03"),
                                                      (4, "April    ", "2024-04")]


def test_stream_goes_on_after_a_batch_load(spark, tmp_path):
    from playstats.operators import ingest as IG
    from playstats.sources import readers
    src, tables = tmp_path / "drops", str(tmp_path / "tables")
    _drop(tmp_path / "batch", "old.csv", ["A - x,20240301,1000,2,0", "B - y,20231231,500,1,0"])
    IG.write_tables(IG.load_play_history(readers.read_play_history(spark, str(tmp_path / "batch"))), tables)
    new = ["A - x,20240301,900,1,1", "A - x,20240302,10,4,0", "C - z,20250101,20,1,0"]
    for i in range(2):                      # the same rows again, as another file
        _drop(src, f"new{i}.csv", new)
        ST.ingest_plays_stream(spark, str(src), tables, str(tmp_path / "ck")).awaitTermination()
    m = readers.read_model(spark, tables)
    assert sorted((r.play_duration_ms, r.play_year) for r in m.plays.collect()) == [(10, 2024), (20, 2025), (500, 2023), (900, 2024)]
    assert {r.name for r in m.artists.collect()} == {"A", "B", "C"} and "mbid" in m.artists.columns
    assert R.genre_match_rate(m).first()["total_artists"] == 3


def test_days_split_over_drops_equal_the_batch_load(spark, tmp_path):
    """Any order of drops, with days split, sent again and corrected, gives the batch loader's rows."""
    import itertools
    from playstats.operators import ingest as IG
    from playstats.sources import readers
    lines = ["A - x,20240301,1000,2,0", "A - x,20240301,900,1,1", "A - x,20240301,900,0,1", "B - y,20240302,500,1,0",
             "B - y,20240302,,3,0", "B - y,bad,70,1,0", "B - y,bad,60,1,0", "C - z,20231231,5,1,0", "A - x,20240301,1000,2,0"]
    _drop(tmp_path / "all", "all.csv", lines)
    key = lambda r: (r["name"], r["title"], str(r["played_at"]), r["play_duration_ms"], r["play_count"], r["skip_count"])

    def rows(plays, tracks, artists):
        return sorted(map(key, plays.join(tracks, "track_id").join(artists, "artist_id").collect()), key=str)

    batch = IG.load_play_history(readers.read_play_history(spark, str(tmp_path / "all")))
    want = rows(batch["plays"], batch["tracks"], batch["artists"])
    for n, order in enumerate((lines, lines[::-1])):
        root = tmp_path / f"run{n}"
        for i, part in enumerate(itertools.batched(order, 3)):
            _drop(root / "drops" if root.exists() else (root.mkdir() or root / "drops"), f"d{i}.csv", list(part))
            ST.ingest_plays_stream(spark, str(root / "drops"), str(root / "tables"), str(root / "ck")).awaitTermination()
        m = readers.read_model(spark, str(root / "tables"))
        assert rows(m.plays, m.tracks, m.artists) == want
        assert m.plays.columns == ["track_id", "played_at", "play_duration_ms", "play_count", "skip_count", "play_year"]
        raw = spark.read.schema(ST.PLAYS_SCHEMA).parquet(str(root / "tables" / "plays"))
        assert raw.filter("change = -1").count() > 0
        months = ST.monthly_plays_stream(spark, str(root / "tables" / "plays"), str(root / "ckm"), f"months{n}")
        months.awaitTermination()
        got = sorted(map(tuple, spark.sql(f"SELECT * FROM months{n}").collect()), key=str)
        assert got == sorted(map(tuple, R.plays_per_month(m).collect()), key=str)


def test_a_batch_meets_the_stored_plays_in_one_shuffle(spark, tmp_path, monkeypatch):
    from playstats.operators import ingest as IG
    plans, write = [], IG.write_tables

    def record(tables, *args):
        if "plays" in tables:
            plans.append(tables["plays"]._jdf.queryExecution().executedPlan().toString())
        write(tables, *args)

    monkeypatch.setattr(IG, "write_tables", record)
    for i, line in enumerate(("A - x,20240301,1000,2,0", "A - x,20240301,900,1,1")):
        _drop(tmp_path / "drops", f"d{i}.csv", [line])
        ST.ingest_plays_stream(spark, str(tmp_path / "drops"), str(tmp_path / "tables"), str(tmp_path / "ck")).awaitTermination()
    assert len(plans) == 2
    for plan in plans:
        assert sum("hashpartitioning" in x and "played_at" in x for x in plan.splitlines()) == 1 and "LeftOuter" not in plan
    raw = spark.read.schema(ST.PLAYS_SCHEMA).parquet(str(tmp_path / "tables" / "plays"))
    assert sorted((r.play_duration_ms, r.change) for r in raw.collect()) == [(900, 1), (1000, -1), (1000, 1)]
