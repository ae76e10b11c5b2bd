"""Command line: load raw files into model tables, run a report over them.

    python -m playstats.cli load-history  plays.csv   /data/model
    python -m playstats.cli load-catalog  songs.csv   /data/catalog [--match title]
    python -m playstats.cli enrich       /data/model lookups.json /data/enriched
    python -m playstats.cli report loyalty_ratio /data/model [--out /data/out/loyalty]
    python -m playstats.cli features     /data/model /data/out/features
    python -m playstats.cli clusters     /data/model /data/out/clusters [--format csv]
    python -m playstats.cli recommend    /data/model [--track 17] [--n 5] [--out /data/out/recs]
    python -m playstats.cli stream       /data/drops /data/model /data/ck

``report`` takes any function name of :mod:`playstats.plans.reports` or
:mod:`playstats.plans.features` that accepts a model; without ``--out`` it prints
the first rows.
"""

from __future__ import annotations

import argparse

from playstats.operators import enrich as EN
from playstats.operators import ingest as IG
from playstats.plans import features as FT
from playstats.plans import recommend as RC
from playstats.plans import reports as RP
from playstats.session import get_session
from playstats.sources import readers
from playstats.streaming.plays_stream import ingest_plays_stream


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="playstats")
    sub = ap.add_subparsers(dest="cmd", required=True)
    h = sub.add_parser("load-history")
    h.add_argument("csv")
    h.add_argument("out")
    c = sub.add_parser("load-catalog")
    c.add_argument("csv")
    c.add_argument("out")
    c.add_argument("--match", default="title_artist", choices=["title_artist", "title"])
    r = sub.add_parser("report")
    r.add_argument("name")
    r.add_argument("model")
    r.add_argument("--out")
    e = sub.add_parser("enrich")
    e.add_argument("model")
    e.add_argument("lookups")
    e.add_argument("out")
    f = sub.add_parser("features")
    f.add_argument("model")
    f.add_argument("out")
    k = sub.add_parser("clusters")
    k.add_argument("model")
    k.add_argument("out")
    k.add_argument("--format", default="csv")
    n = sub.add_parser("recommend")
    n.add_argument("model")
    n.add_argument("--track", type=int)
    n.add_argument("--n", type=int, default=5)
    n.add_argument("--out")
    s = sub.add_parser("stream")
    s.add_argument("drops")
    s.add_argument("model")
    s.add_argument("checkpoint")
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = get_session(args.master)
    if args.cmd == "load-history":
        IG.write_tables(IG.load_play_history(readers.read_play_history(spark, args.csv)), args.out)
    elif args.cmd == "load-catalog":
        raw = readers.read_song_catalog(spark, args.csv)
        IG.write_tables(IG.load_song_catalog(raw, args.match), args.out)
    elif args.cmd == "enrich":
        loaded = {t: df for t, df in vars(readers.read_model(spark, args.model)).items() if df is not None}
        IG.write_tables(EN.enrich_tables(loaded, readers.read_lookup_responses(spark, args.lookups)), args.out)
    elif args.cmd == "features":
        FT.feature_matrix(readers.read_model(spark, args.model)).write.mode("overwrite").parquet(args.out)
    elif args.cmd == "clusters":
        RC.export_clusters(RC.cluster_tracks(readers.read_model(spark, args.model)), args.out, args.format)
    elif args.cmd == "stream":
        ingest_plays_stream(spark, args.drops, args.model, args.checkpoint).awaitTermination()
    else:
        m = readers.read_model(spark, args.model)
        if args.cmd == "report":
            df = (getattr(RP, args.name, None) or getattr(FT, args.name))(m)
        elif args.track is None:   # a random track, with the cluster labels
            df = RC.recommend_for_random(RC.cluster_tracks(m).drop("features"), n=args.n).filter("role != 'background'")
        else:
            df = RC.recommend_by_feature(FT.feature_matrix(m, with_vector=False), args.track, n=args.n)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(20, truncate=False)


if __name__ == "__main__":
    main()
