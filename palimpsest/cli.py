"""Command line: ``python -m palimpsest.cli build|sync``."""

from __future__ import annotations

import argparse
import logging
import os
import sys
from datetime import UTC, datetime


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="palimpsest")
    sub = p.add_subparsers(dest="command", required=True)
    names = lambda s: s.split(",")
    b, s = sub.add_parser("build"), sub.add_parser("sync")
    b.add_argument("input", nargs="?")
    b.add_argument("-d", "--dir")
    b.add_argument("-o", "--output")
    s.add_argument("-o", "--output", required=True)
    b.add_argument("--domain")
    b.add_argument("--large-pages", action="store_true", help="stream revisions of pages too large for memory")
    b.add_argument("--sqlite", help="also merge the index into this SQLite file")
    s.add_argument("--domain", required=True)
    for x in (b, s):
        x.add_argument("--namespace", type=names)
        x.add_argument("--db", default="index")
        x.add_argument("--no-db", action="store_true")
        x.add_argument("--parquet")
        x.add_argument("-j", "--jobs", default="*")
    s.add_argument("--ongoing", action="store_true")
    s.add_argument("--interval", type=int)
    s.add_argument("--replay", help="file of recorded replies, one JSON a line, taken instead of the live interface")
    s.add_argument("--pages", type=int, help="feed pages a batch takes at most")
    return p


def to_server(store, server: dict[str, str], before: dict) -> dict:
    """Merge what the index got since the state ``before`` into the server's; returns the state now."""
    from palimpsest.sources import postgres

    url, properties = postgres.jdbc(server)
    now = store.state()
    if now != before:
        postgres.merge_tables(store.since(before), postgres.connector(server), postgres.stage_by_jdbc(url, properties))
    return now


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, stream=sys.stderr, format="%(asctime)s %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    from palimpsest.session import local_session
    from palimpsest.sources import postgres

    server = postgres.settings() if not args.no_db and not args.parquet else None
    if server:
        postgres.check_tables(postgres.connector(server))
    if args.command == "build":
        source = args.dir or args.input
        if not source or (args.dir and not args.output):
            print("build needs an input file, or -d DIR with -o OUT", file=sys.stderr)
            return 1
        from palimpsest.plans.build import build

        spark = local_session(args.jobs)
        index = None if args.no_db or args.parquet else os.path.join(args.output or ".", args.db)
        from palimpsest.operators.index import IndexStore

        before = IndexStore(spark, index).state() if server and index else {}
        out = build(spark, source, args.output, args.namespace, args.domain, index, args.parquet, large_pages=args.large_pages)
        if args.sqlite and index:
            from palimpsest.sources.sqlite import KEYS, write_sqlite

            store = IndexStore(spark, index)
            write_sqlite({t: store.read(t) for t in KEYS}, args.sqlite)
        if server and index:
            to_server(IndexStore(spark, index), server, before)
        for row in out.toLocalIterator():
            sys.stdout.write(row["record"])
        return 0
    from palimpsest.operators.index import IndexStore
    from palimpsest.operators.metadata import latest_timestamp
    from palimpsest.session import exists
    from palimpsest.sources.changes import contents, fetch_contents, register, replayed
    from palimpsest.streaming.sync import ProgressLog, RecentlySeen, drain, run_stream, start_of

    spark = local_session(args.jobs)
    store = IndexStore(spark, os.path.join(args.output, args.db))
    latest = latest_timestamp(store.read("revisions"), "revision_timestamp").first()[0] if store.exists() else None
    if not latest and args.parquet and exists(spark, args.parquet):
        latest = latest_timestamp(spark.read.parquet(args.parquet)).first()[0]
    if not latest and server:
        latest = postgres.latest(postgres.connector(server))
    start = start_of(latest, datetime.now(UTC)).strftime("%Y-%m-%dT%H:%M:%SZ")
    register(spark)
    feed = spark.readStream.format("recentchanges").option("domain", args.domain).option("start", start).option("namespaces", ",".join(args.namespace or []))
    for name, value in (("replay", args.replay and os.path.abspath(args.replay)), ("pagesperbatch", args.pages)):
        feed = feed.option(name, value) if value else feed
    recorded = replayed(os.path.abspath(args.replay)) if args.replay else None
    lookup = lambda ids: contents(fetch_contents(ids, args.domain, recorded), args.namespace)
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        recent = RecentlySeen(spark)
        job = (spark, feed.load(), os.path.join(args.output, "_checkpoint"), lookup, store, args.domain, args.output, args.namespace)

        def unknown(ids):
            asked = [r[0] for r in ids.collect()]  # of one micro-batch, whose size the source bounds
            known = postgres.known_ids(postgres.connector(server), asked)
            return spark.createDataFrame([(x,) for x in asked if x not in known], "rev_id long")

        state = [store.state()]

        def merged():
            state[0] = to_server(store, server, state[0])

        more = {"parquet": args.parquet, "no_db": args.no_db, "recent": recent} | ({"elsewhere": unknown, "after": merged} if server else {})
        drain(*job, **more)
        if args.ongoing:  # what has gathered is taken; from here on the feed is polled
            run_stream(*job, ongoing=True, interval=args.interval, **more).awaitTermination()
    finally:
        spark.streams.removeListener(listener)
    return 0


if __name__ == "__main__":
    sys.exit(main())
