import json
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from palimpsest.operators.index import IndexStore
from palimpsest.sources.changes import contents, feed_pages, parse_feed
from palimpsest.sources.mwrev import read_archive
from palimpsest.streaming.sync import StaleIndexError, process_batch, run_stream, start_of, valid_items

NOW = datetime(2026, 6, 1, tzinfo=UTC)


def test_resume():
    assert start_of(None, NOW) == NOW - timedelta(hours=24)
    assert start_of("2026-05-31T12:00:00Z", NOW) == datetime(2026, 5, 30, 12, tzinfo=UTC)
    assert start_of("2026-05-02T00:00:00Z", NOW)  # exactly 30 days is not too old
    with pytest.raises(StaleIndexError):
        start_of("2026-05-01T23:59:59Z", NOW)


def test_paging():
    replies = {None: {"query": {"recentchanges": [{"revid": 1}]}, "continue": {"rccontinue": "x"}}, "x": {"query": {"recentchanges": [{"revid": 2}]}}}
    assert [[i["revid"] for i in items] for items, _ in feed_pages(lambda p: replies[p.get("rccontinue")], "t", ["0"])] == [[1], [2]]
    assert list(feed_pages(lambda p: {"query": {"recentchanges": []}}, "t")) == []
    with pytest.raises(RuntimeError):
        list(feed_pages(lambda p: {"error": 1}, "t"))


def test_feed_json(spark):
    good = {"query": {"recentchanges": [{"revid": 1, "pageid": 2, "ns": 0, "title": "T", "timestamp": "t"}, {"revid": 0, "pageid": 3, "ns": 0}]}}
    df = spark.createDataFrame([(json.dumps(good),), ("{}",), ("nonsense",), (None,)], "value string")
    rows = parse_feed(df)
    assert rows.count() == 2 and valid_items(rows).count() == 1 and valid_items(rows, ["4"]).count() == 0


def test_contents_as_array_or_map(spark):
    page = {"ns": 0, "pageid": 5, "revisions": [{"revid": 9, "parentid": 0, "timestamp": "2026-01-01T00:00:00Z", "slots": {"main": {"content": "x"}}}, {"revid": 0, "timestamp": "t"}, {"revid": 8, "timestamp": ""}]}
    replies = [{"query": {"pages": [page]}}, {"query": {"pages": {"5": page}}}, {"query": {}}]
    rows = contents(spark.createDataFrame([(json.dumps(r),) for r in replies], "value string")).collect()
    assert [(r["rev_id"], r["parent_rev_id"], r["user_id"], r["text"]) for r in rows] == [(9, 0, 0, "x")] * 2


ITEMS = "revid long, pageid long, ns long, title string, timestamp string"


def _lookup(spark):
    return lambda ids: ids.select(
        "rev_id", F.lit(0).cast("long").alias("parent_rev_id"), (F.col("rev_id") * 10).alias("page_id"), F.lit(0).alias("ns"), F.lit(3).cast("long").alias("user_id"),
        F.concat(F.lit("2026-05-3"), (F.col("rev_id") % 2).cast("string"), F.lit("T00:00:00Z")).alias("timestamp"), F.concat(F.lit("text "), F.col("rev_id").cast("string")).alias("text"),
    )


def test_batches_are_idempotent(spark, tmp_path):
    store, out = IndexStore(spark, str(tmp_path / "index")), str(tmp_path)
    feed = spark.createDataFrame([(1, 10, 0, "A", "2026-05-31T00:00:00Z"), (2, 20, 0, "B", "2026-05-30T00:00:00Z"), (2, 20, 0, "B", "2026-05-30T00:00:00Z"), (3, 30, 7, "C", "t"), (4, None, None, None, None), (None, None, None, None, None)], ITEMS)
    assert process_batch(spark, feed, _lookup(spark), store, "x.org", out, ["0"])["revisions"] == 3  # a row without page or title still names a revision
    assert process_batch(spark, feed, _lookup(spark), store, "x.org", out, ["0"])["revisions"] == 0
    assert store.read("revisions").count() == 3 and store.read("web_resources").count() == 2
    assert sorted(r["rev_id"] for r in read_archive(spark, out + "/recentchanges").collect()) == ["1", "2", "4"]


def test_stream_runs_once(spark, tmp_path):
    src = str(tmp_path / "feed")
    spark.createDataFrame([(5, 50, 0, "E", "2026-05-31T00:00:00Z")], ITEMS).write.parquet(src)
    store = IndexStore(spark, str(tmp_path / "index"))
    q = run_stream(spark, spark.readStream.schema(ITEMS).parquet(src), str(tmp_path / "cp"), _lookup(spark), store, "x.org", str(tmp_path))
    q.awaitTermination(120)
    assert store.read("revisions").first()["revision_id"] == 5


def test_stream_sinks(spark, tmp_path):
    src, meta = str(tmp_path / "feed"), str(tmp_path / "meta.parquet")
    store = IndexStore(spark, str(tmp_path / "index"))

    def run(rows, out, **sink):
        spark.createDataFrame(rows, ITEMS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(ITEMS).option("maxFilesPerTrigger", 1).parquet(src)
        q = run_stream(spark, stream, str(tmp_path / out / "cp"), _lookup(spark), store, "x.org", str(tmp_path / out), **sink)
        q.awaitTermination(120)
        return sorted(r["rev_id"] for r in read_archive(spark, str(tmp_path / out / "recentchanges")).collect())

    e, f = (5, 50, 0, "E", "2026-05-31T00:00:00Z"), (6, 60, 0, "F", "2026-05-30T00:00:00Z")
    assert run([e], "p", parquet=meta) == ["5"]
    assert run([e, f], "p", parquet=meta) == ["5", "6"]
    got = [(r["type"], r["page_id"], r["title"], r["rev_id"]) for r in spark.read.parquet(meta).collect()]
    assert sorted(got, key=str) == sorted([("page", 50, "E", None), ("page", 60, "F", None), ("revision", 50, None, 5), ("revision", 60, None, 6)], key=str)
    assert run([e], "n", no_db=True) == ["5", "6"]  # three batches, of which each repeats some
    assert not store.exists()
    run([f], "i")
    assert store.read("revisions").count() == 2
    assert run([f], "m", no_db=True) == ["5", "6"] and store.read("revisions").count() == 2  # the index is not asked


def recorded(path, revisions, page_size=2):
    """A file of feed pages and contents of the given revisions, all of the last hours."""
    from datetime import datetime as at

    stamp = lambda i: (at.now(UTC) - timedelta(hours=2) + timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%SZ")
    items = [{"revid": i, "pageid": i * 10, "ns": 0, "title": f"P{i}", "timestamp": stamp(i)} for i in revisions]
    lines = [{"query": {"recentchanges": items[k : k + page_size]}} for k in range(0, len(items), page_size)]
    lines += [{"query": {"pages": [{"ns": 0, "pageid": i * 10, "revisions": [{"revid": i, "parentid": 0, "timestamp": stamp(i), "userid": 3, "slots": {"main": {"content": f"text {i}"}}}]}]}} for i in revisions]
    path.write_text("\n".join(map(json.dumps, lines)))


@pytest.mark.parametrize("pages", [100, 3, 1])
def test_command_line_drains_all_pages(spark, tmp_path, pages):
    from palimpsest import cli

    recorded(tmp_path / "replies.jsonl", range(1, 9))  # four pages of two
    run = lambda *more: cli.main(["sync", "--domain", "x.org", "-o", str(tmp_path / "o"), "--replay", str(tmp_path / "replies.jsonl"), "--pages", str(pages), "-j", "4", *more])
    assert run() == 0
    store = IndexStore(spark, str(tmp_path / "o" / "index"))
    assert sorted(r["revision_id"] for r in store.read("revisions").collect()) == list(range(1, 9)) and store.read("web_resources").count() == 8
    assert sorted(int(r["rev_id"]) for r in read_archive(spark, str(tmp_path / "o" / "recentchanges")).collect()) == list(range(1, 9))
    assert run() == 0 and store.read("revisions").count() == 8  # nothing more comes


def test_command_line_sinks(spark, tmp_path):
    from palimpsest import cli

    recorded(tmp_path / "replies.jsonl", range(1, 4))
    run = lambda out, *more: cli.main(["sync", "--domain", "x.org", "-o", str(tmp_path / out), "--replay", str(tmp_path / "replies.jsonl"), "-j", "4", *more])
    assert run("p", "--parquet", str(tmp_path / "m")) == 0 and not IndexStore(spark, str(tmp_path / "p" / "index")).exists()
    assert sorted(r["rev_id"] for r in spark.read.parquet(str(tmp_path / "m")).filter("type = 'revision'").collect()) == [1, 2, 3]
    assert run("n", "--no-db") == 0 and not IndexStore(spark, str(tmp_path / "n" / "index")).exists()
    assert read_archive(spark, str(tmp_path / "n" / "recentchanges")).count() == 3


@pytest.mark.parametrize("where", ["before", "after"])
def test_crash_between_append_and_commit(spark, tmp_path, monkeypatch, where):
    """What a batch appended before it failed is cut off; what was committed stays, even if the lengths were not."""
    from palimpsest.sources.mwrev import DailyArchives, slice_of

    store, out = IndexStore(spark, str(tmp_path / "index")), str(tmp_path)
    feed = lambda *ids: spark.createDataFrame([(i, i * 10, 0, "A", "2026-05-31T00:00:00Z") for i in ids], ITEMS)
    take = lambda *ids: process_batch(spark, feed(*ids), _lookup(spark), store, "x.org", out)["revisions"]
    assert take(1, 3) == 2

    def crash(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(*((store, "commit") if where == "before" else (DailyArchives, "commit")), crash)
        with pytest.raises(OSError):
            take(1, 3, 5, 7)
    assert take(1, 3, 5, 7) == (2 if where == "before" else 0)
    assert take(9, 11) == 2
    assert sorted(int(r["rev_id"]) for r in read_archive(spark, out + "/recentchanges").collect()) == [1, 3, 5, 7, 9, 11]
    names = {r["id"]: r["file_path"] for r in store.read("revision_bundles").collect()}
    rows = store.read("revisions").collect()
    assert len(rows) == 6 and all(slice_of(f"{out}/{names[r['found_in_bundle']]}", r["offset_begin"], r["length"]) == b" text %d\n" % r["revision_id"] for r in rows)


def test_feed_offsets():
    from palimpsest.sources.changes import ChangesReader

    item = lambda i, t: {"revid": i, "timestamp": f"2026-05-30T00:00:0{t}Z"}
    log = [item(1, 1), item(2, 2), item(3, 2), item(4, 3)]

    def fetch(p):
        found = [x for x in log if x["timestamp"] >= p["rcstart"]]
        at = int(p.get("rccontinue", 0))
        return {"query": {"recentchanges": found[at : at + 2]}} | ({"continue": {"rccontinue": str(at + 2)}} if at + 2 < len(found) else {})

    r = ChangesReader({"start": "2026-05-30T00:00:00Z", "pagesperbatch": "1"}, fetch)
    read = lambda at: (lambda got: ([x[0] for x in got[0]], got[1]))(r.read(at))
    at = r.initialOffset()
    one, at1 = read(at)
    two, at2 = read(at1)
    assert (one, two) == ([1, 2], [3, 4]) and at2["token"] == "" and [x[0] for x in r.readBetweenOffsets(at, at2)] == [1, 2, 3, 4]
    assert read(at2) == ([], at2)  # nothing new at the last instant: the offset stays and no row comes again
    log.append(item(5, 3))
    assert read(at2)[0] == [4, 5] and read(read(at2)[1])[0] == []


def test_replayed_feed_streams(spark, tmp_path):
    from palimpsest.sources.changes import fetch_contents, register

    item = lambda i: {"revid": i, "pageid": i * 10, "ns": 0, "title": f"P{i}", "timestamp": f"2026-05-30T00:00:0{i}Z"}
    (tmp_path / "replies.jsonl").write_text("\n".join(json.dumps({"query": {"recentchanges": [item(i), item(i + 1)]}}) for i in (1, 3)))
    register(spark)
    feed = spark.readStream.format("recentchanges").option("start", "2026-05-30T00:00:00Z").option("replay", str(tmp_path / "replies.jsonl")).load()
    q = feed.writeStream.format("memory").queryName("replayed").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            q.awaitTermination(1)
            if spark.table("replayed").select("revid").distinct().count() == 4:
                break
    finally:
        q.stop()
    assert {r["revid"] for r in spark.table("replayed").collect()} == {1, 2, 3, 4}
    page = lambda p: {"query": {"pages": [{"ns": 0, "pageid": 1, "revisions": [{"revid": int(i), "timestamp": "t"} for i in p["revids"].split("|")]}]}}
    ids = spark.range(1, 121).withColumnRenamed("id", "rev_id").coalesce(1)
    replies = fetch_contents(ids, "x", page)
    assert replies.count() == 3 and contents(replies).count() == 120


def test_ttl_state(spark, tmp_path):
    from palimpsest.streaming.sync import drop_recent, ttl_processor

    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "2026-01-01T00:00:00"), (1, "2026-01-01T01:00:00"), (2, "2026-01-01T02:00:00")], "k long, t string").withColumn("ts", F.to_timestamp("t")).write.parquet(src)
    stream = lambda: spark.readStream.schema("k long, t string, ts timestamp").parquet(src)
    q = drop_recent(stream(), "k").writeStream.format("memory").queryName("recent").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["k"] for r in spark.table("recent").collect()) == [1, 2]
    out = stream().groupBy("k").transformWithStateInPandas(statefulProcessor=ttl_processor(), outputStructType="key long, rows long", outputMode="append", timeMode="ProcessingTime")
    q = out.writeStream.format("memory").queryName("ttl").outputMode("append").trigger(processingTime="1 second").start()
    try:
        for _ in range(60):
            q.awaitTermination(1)
            if spark.table("ttl").count():
                break
    finally:
        q.stop()
    assert sorted(r["key"] for r in spark.table("ttl").collect()) == [1, 2]


def test_recording_is_parsed_once(tmp_path, monkeypatch):
    """A way through a recording of n pages parses n lines, not n times n."""
    import gzip
    import pickle

    from palimpsest.sources import changes

    recorded(tmp_path / "replies.jsonl", range(1, 81))  # 40 pages, 80 contents
    lines = (tmp_path / "replies.jsonl").read_bytes().splitlines(keepends=True)
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "_SUCCESS").touch()
    for k in range(0, len(lines), 50):
        (tmp_path / "parts" / f"part-{k:05d}.gz").write_bytes(gzip.compress(b"".join(lines[k : k + 50])))
    parsed = []
    monkeypatch.setattr(changes.json, "loads", lambda x, loads=json.loads: parsed.append(1) or loads(x))
    for path in ("replies.jsonl", "parts"):
        parsed.clear()
        fetch = changes.replayed(str(tmp_path / path))
        ways = [[i["revid"] for items, _ in feed_pages(fetch, "1970-01-01T00:00:00Z") for i in items] for _ in range(2)]
        assert ways == [list(range(1, 81))] * 2 and len(parsed) <= len(lines) + 40
        last = fetch(changes.feed_params("1970-01-01T00:00:00Z", token="39"))["query"]["recentchanges"][-1]["timestamp"]
        assert [[i["revid"] for i in items] for items, _ in feed_pages(fetch, last)] == [[80]]
        fetch = pickle.loads(pickle.dumps(fetch))  # as it is sent to executors
        assert [p["revisions"][0]["revid"] for p in fetch({"revids": "70|3|99"})["query"]["pages"]] == [3, 70]
    with (tmp_path / "replies.jsonl").open("a") as f:
        f.write("\n" + json.dumps({"query": {"recentchanges": [{"revid": 81, "timestamp": last}]}}))
    fetch = changes.replayed(str(tmp_path / "replies.jsonl"))
    assert [[i["revid"] for i in items] for items, _ in feed_pages(fetch, last)] == [[80], [81]]
    with (tmp_path / "replies.jsonl").open("a") as f:  # a recording may grow
        f.write("\n" + json.dumps({"query": {"recentchanges": [{"revid": 82, "timestamp": last}]}}))
    assert [[i["revid"] for i in items] for items, _ in feed_pages(fetch, last)] == [[80], [81], [82]]


def test_last_instant_of_many_pages():
    """More pages of one instant, or without any, than a batch takes: the way ends, and what comes later is found."""
    from palimpsest.sources.changes import ChangesReader

    log = [{"revid": i} if i < 3 else {"revid": i, "timestamp": "2026-05-30T00:00:00Z"} for i in range(9)]

    def fetch(p):
        at = int(p.get("rccontinue", 0))
        return {"query": {"recentchanges": log[at : at + 2]}} | ({"continue": {"rccontinue": str(at + 2)}} if at + 2 < len(log) else {})

    def drained(r, at):
        got = []
        for _ in range(20):
            rows, after = r.read(at)
            if after == at:
                assert not list(rows)
                return got, at
            got, at = got + [x[0] for x in rows], after
        raise AssertionError("it doesn't end")

    r = ChangesReader({"start": "2026-05-29T00:00:00Z", "pagesperbatch": "2"}, fetch)
    got, at = drained(r, r.initialOffset())
    assert got == list(range(9))
    log.append({"revid": 9, "timestamp": "2026-05-30T00:00:00Z"})
    got, at = drained(r, at)
    assert got == list(range(10)) and r.read(at)[1] == at
    from palimpsest.sources.changes import ArrowChangesReader

    a = ArrowChangesReader({"start": "2026-05-29T00:00:00Z"}, fetch)
    assert [b.column("revid").to_pylist() for b in a.read(a.initialOffset())[0]] == [list(range(10))]
    log.append({"revid": 10, "title": 7})  # not a string: left to Spark
    assert list(a.read(a.initialOffset())[0])[-1] == (10, None, None, 7, None)


def test_feed_replay_keeps_every_event(spark, tmp_path):
    """Repeated events, and many of the last instant: as many rows as in SQL."""
    import duckdb

    from palimpsest.plans import catalogue

    d = str(tmp_path)
    duckdb.sql(f"""COPY (SELECT i + 1 AS event_id, CASE WHEN i % 7 > 0 THEN TIMESTAMP '2026-05-30' + to_seconds(CAST(i // 500 AS INT)) END AS ts,
      i % 11 AS user_id, 'view' AS event_type, n / 2 AS value, '' AS props FROM range(1500) r(i), range(2) s(n)) TO '{d}/events.parquet' (FORMAT parquet)""")
    duckdb.sql(f"CREATE OR REPLACE TEMP VIEW events AS SELECT * FROM '{d}/events.parquet'")
    want = duckdb.sql(catalogue.SQL["feed_replay"]).fetchall()
    assert len(want) == 1200 and sorted(map(tuple, catalogue.feed_replay(spark, d).collect()), key=str) == sorted(want, key=str)
