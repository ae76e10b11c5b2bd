"""The driver contract, and a spot check of Spark vs DuckDB at sf0.001."""

import duckdb

import __spark_entry__ as E
from playstats.sources.fixtures import TABLES

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["name", "plays", "skips", "ratio"]
    assert df.count() >= 0


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return str(v)


def test_oracle_spot_check(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sql = E.oracle_sql()
    for key in ("loyalty_ratio", "top_genres_per_year", "track_features_clean", "build_plays",
                "apply_enrichment", "most_repeated_tracks"):
        sdf = E.queries()[key](spark, SF_SMALL)
        s = sorted("|".join(_norm(x) for x in r) for r in sdf.select(*sorted(sdf.columns)).collect())
        res = con.execute(sql[key])
        cols = [d[0] for d in res.description]
        order = sorted(range(len(cols)), key=lambda i: cols[i])
        d = sorted("|".join(_norm(r[i]) for i in order) for r in res.fetchall())
        assert s == d, key


def test_every_registered_query_runs(spark):
    failures = {}
    for key, fn in E.queries().items():
        try:
            df = fn(spark, SF_SMALL)
            assert df.count() >= 0 and len(df.columns) > 0
        except Exception as e:  # noqa: BLE001
            failures[key] = str(e)[:200]
    assert not failures, failures


def test_model_rebuilt_when_folder_removed(spark):
    import shutil
    from playstats.sources import fixtures
    m = fixtures.model(spark, SF_SMALL)
    path = m.plays.inputFiles()[0].split("/plays/")[0].replace("file:", "")
    n = m.plays.count()
    shutil.rmtree(path)
    m2 = fixtures.model(spark, SF_SMALL)
    assert m2.plays.count() == n


def test_a_changed_file_in_a_partition_folder_is_noticed(spark, tmp_path):
    from playstats.sources import fixtures
    spark.range(10).selectExpr("id", "id % 2 AS part").write.partitionBy("part").parquet(f"{tmp_path}/events.parquet")
    assert fixtures.table(spark, str(tmp_path), "events").count() == 10
    spark.range(5).write.parquet(f"{tmp_path}/events.parquet/part=7")
    assert fixtures.table(spark, str(tmp_path), "events").count() == 15
