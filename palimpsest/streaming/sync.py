"""Resume window, recently-seen filter and the idempotent micro-batch sink."""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from palimpsest.functions import body, daily_path, header, instant
from palimpsest.operators.index import IndexStore, first_wins, unseen
from palimpsest.operators.metadata import metadata, write_metadata
from palimpsest.schema import METADATA
from palimpsest.sources.mwrev import DailyArchives, append_frames

LOG = logging.getLogger(__name__)
#: Overlap of a first cycle, lifetime of a seen revision, age beyond which an index is too old, poll interval.
OVERLAP, TTL, STALE = timedelta(hours=24), timedelta(hours=25), timedelta(days=30)
INTERVAL_MINUTES = 10


class StaleIndexError(RuntimeError):
    """The index ends too long ago for the feed to close the gap."""


def parse_utc(text: str) -> datetime:
    d = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return (d if d.tzinfo else d.replace(tzinfo=UTC)).astimezone(UTC)


def start_of(latest: str | None, now: datetime) -> datetime:
    """Where a first cycle begins: 24 hours before the latest indexed instant, or before ``now`` for an empty index.

    Raises StaleIndexError when the index ends strictly more than 30 days before ``now``.
    """
    if not latest:
        return now - OVERLAP
    at = parse_utc(latest)
    if now - at > STALE:
        raise StaleIndexError(f"latest indexed revision {latest} is more than {STALE.days} days old")
    return at - OVERLAP


def interval_minutes(arg: int | None) -> int:
    return arg or int(os.environ.get("SYNC_INTERVAL", INTERVAL_MINUTES))


def valid_items(feed: DataFrame, namespaces: list[str] | None = None) -> DataFrame:
    """Feed rows with page, namespace and title, inside the namespaces: the pages side-output takes these before any de-duplication."""
    out = feed.dropna(subset=["pageid", "ns", "title"])
    return out if namespaces is None else out.filter(F.col("ns").cast("string").isin(namespaces))


def drop_recent(feed: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """One row per key within 25 hours of event time; state older than the watermark is dropped."""
    return feed.withWatermark(ts, "25 hours").dropDuplicatesWithinWatermark([key])


def ttl_processor():
    """Processor for ``transformWithStateInPandas``: a key passes once per 25 hours of processing time.

    Needs the RocksDB state store; run it with a bounded wait, as a processing-time query doesn't end by itself.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class SeenOnce(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "at long", ttlDurationMs=int(TTL.total_seconds() * 1000))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            for pdf in rows:
                if not self.seen.exists():
                    self.seen.update((1,))
                    yield pd.DataFrame({"key": [key[0]], "rows": [len(pdf)]})

        def close(self) -> None:
            pass

    return SeenOnce()


def batch_high_water(feed: DataFrame, order: str, ts: str, page: int = 500) -> DataFrame:
    """Last timestamp of each feed page of ``page`` rows: (page, last_ts)."""
    from palimpsest.operators.index import number_rows

    n = number_rows(feed.select(order, ts), [order])
    return n.groupBy(F.floor((F.col("rn") - 1) / page).cast("long").alias("page")).agg(F.max_by(ts, order).alias("last_ts"))


def archive_contents(contents: DataFrame, out_dir: str, lengths: dict[str, tuple[int, int]]) -> DataFrame:
    """Append one micro-batch of revisions to its daily archives at their committed ``lengths``; returns their places for the index.

    One task holds the rows of one day of one micro-batch, whose size the source bounds (``changes.PAGES_PER_BATCH``). A retried task writes the same again.
    """
    c = F.col
    rows = contents.select(
        "rev_id", "parent_rev_id", "page_id", "timestamp", daily_path(c("timestamp")).alias("file_path"),
        header(c("page_id"), c("ns"), c("rev_id"), c("parent_rev_id"), c("timestamp"), c("user_id"), "0").alias("header"), body(c("text")).alias("body"),
    )

    def append(pdf):
        pdf = pdf.sort_values(["timestamp", "rev_id"])
        name = pdf["file_path"].iloc[0]
        places = append_frames(list(zip(pdf["header"], pdf["body"], strict=True)), os.path.join(out_dir, name), *lengths[name])
        out = pdf[["rev_id", "parent_rev_id", "page_id", "file_path", "timestamp"]].copy()
        for i, name in enumerate(("offset_begin", "length", "frame_offset", "frame_length")):
            out[name] = [p[i] for p in places]
        return out

    fields = "rev_id long, parent_rev_id long, page_id long, file_path string, timestamp string, offset_begin long, length long, frame_offset long, frame_length long"
    return rows.groupBy("file_path").applyInPandas(append, fields)


class RecentlySeen:
    """Revisions taken by this process in the last 25 hours: written ids of each batch. Runs that keep no index know their revisions by this alone."""

    def __init__(self, spark: SparkSession):
        self.spark, self.taken = spark, []

    def unseen(self, ids: DataFrame) -> DataFrame:
        from palimpsest.session import remove

        old = [p for at, p in self.taken if time.monotonic() - at > TTL.total_seconds()]
        remove(self.spark, *old)
        self.taken = [(at, p) for at, p in self.taken if p not in old]
        return ids.join(self.spark.read.schema("rev_id long").parquet(*[p for _, p in self.taken]), "rev_id", "left_anti") if self.taken else ids

    def add(self, ids: DataFrame) -> None:
        from palimpsest.session import stage

        self.taken.append((time.monotonic(), stage(ids.select("rev_id").distinct(), "seen")[1]))


def process_batch(
    spark: SparkSession, feed: DataFrame, lookup, store: IndexStore, domain: str, out_dir: str, namespaces: list[str] | None = None, parquet: str | None = None, no_db: bool = False, recent: RecentlySeen | None = None, elsewhere=None
) -> dict:
    """One cycle: page side-output, anti-join against what is known, content lookup, archive append, index merge or metadata export.

    ``lookup`` maps a DataFrame of rev_ids to contents. ``parquet`` takes the place of the index as sink: new metadata rows are appended to it, and
    its revisions count as known like those of an index. With ``no_db`` the index is neither read nor written. Repeating a batch whose commit went through
    changes nothing (without any sink: in the process of ``recent``); one that failed before its commit is taken again whole, and what it appended to
    archives is cut off. Every revision of the feed is looked up, also of rows that lack a page or title.
    """
    from palimpsest.session import exists, remove, stage

    items = valid_items(feed, namespaces)
    pages = items.select("pageid", "ns", "title", "timestamp")
    asked = feed if namespaces is None else feed.filter(F.col("ns").isNull() | F.col("ns").cast("string").isin(namespaces))
    ids = asked.filter("revid > 0").select(F.col("revid").alias("rev_id")).distinct()
    fresh = ids if no_db else unseen(ids, store.read("revisions"))
    known = spark.read.schema(METADATA).parquet(parquet) if parquet and exists(spark, parquet) else None
    if known is not None:
        fresh = fresh.join(known.filter("type = 'revision'").select("rev_id").distinct(), "rev_id", "left_anti")
    if recent:
        fresh = recent.unseen(fresh)
    if elsewhere:  # a database that knows revisions, asked for those of this batch
        fresh = elsewhere(fresh)
    got, got_path = stage(lookup(fresh).filter("rev_id <> 0 AND timestamp <> ''"), "contents")
    one = first_wins(got, ["rev_id"], ["timestamp"])
    archives = DailyArchives(out_dir)
    days = [r[0] for r in one.select(daily_path(F.col("timestamp"))).distinct().collect()]  # a name a day

    def committed(rev_id: int, file_path: str, offset: int) -> bool:
        """Did the sink take the row that stands for a batch? Without a sink, what was archived counts."""
        if parquet:
            return known is not None and not known.filter((F.col("rev_id") == rev_id) & (F.col("file_path") == file_path) & (F.col("offset_begin") == offset)).isEmpty()
        if no_db:
            return True
        rows = store.read("revisions").filter((F.col("revision_id") == rev_id) & (F.col("offset_begin") == offset))
        return not rows.join(store.read("revision_bundles").filter(F.col("file_path") == file_path), F.col("found_in_bundle") == F.col("id")).isEmpty()

    placed, path = stage(archive_contents(one, out_dir, archives.begin(days, committed)), "placed")
    ends = placed.groupBy("file_path").agg(F.max(F.col("offset_begin") + F.col("length")), F.max(F.col("frame_offset") + F.col("frame_length")), F.max(F.struct("offset_begin", "rev_id"))).collect()
    if ends:
        archives.prepare({r[0]: (r[1], r[2]) for r in ends}, (ends[0][3]["rev_id"], ends[0][0], ends[0][3]["offset_begin"]))
    site = spark.createDataFrame([("feed", domain)], "file string, domain string")
    page_rows = pages.select(F.lit("feed").alias("file"), F.col("pageid").alias("page_id"), F.col("ns").cast("int").alias("ns"), "title", F.coalesce(instant(F.col("timestamp")), F.lit(0)).alias("seq"))
    if parquet:
        rows = metadata(page_rows.dropDuplicates(["page_id", "ns", "title"]), placed)
        if known is not None:
            same = known.filter("type = 'page'").select("page_id", "ns", "title").distinct()
            pages_left = rows.filter("type = 'page'").join(same, ["page_id", "ns", "title"], "left_anti")
            rows = pages_left.unionByName(rows.filter("type = 'revision'"))
        write_metadata(rows, parquet, append=True)
    elif not no_db:
        store.apply(page_rows, placed, site)
    archives.commit()
    if recent:
        recent.add(placed)
    n = placed.count()
    remove(spark, path, got_path)
    return {"revisions": n}


class ProgressLog(StreamingQueryListener):
    """Start, progress and end of streaming queries as log lines: ``spark.streams.addListener(ProgressLog())``."""

    def onQueryStarted(self, event):
        LOG.info("sync %s started", event.name or event.id)

    def onQueryProgress(self, event):
        p = event.progress
        LOG.info("sync batch %d: %d rows in", p.batchId, p.numInputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        LOG.info("sync ended%s", f": {event.exception}" if event.exception else "")


def run_stream(spark: SparkSession, feed: DataFrame, checkpoint: str, lookup, store: IndexStore, domain: str, out_dir: str, namespaces=None, ongoing: bool = False, interval: int | None = None, parquet: str | None = None, no_db: bool = False, recent: RecentlySeen | None = None, taken: list | None = None, elsewhere=None, after=None):
    """Start following ``feed`` (a stream of items). Run once takes what is available, up to one batch of a bounded source (see ``drain``); ongoing polls.

    Sinks as in ``process_batch``. Revisions of the last 25 hours are not looked up again. ``taken`` gets the result of each batch, and ``after`` is called when a batch is
    committed; a batch is taken again if it fails.
    """
    recent = RecentlySeen(spark) if recent is None else recent

    def each(batch: DataFrame, epoch: int) -> None:
        out = process_batch(spark, batch, lookup, store, domain, out_dir, namespaces, parquet, no_db, recent, elsewhere)
        LOG.info("sync batch %d: %d revisions archived", epoch, out["revisions"])
        if after:
            after()
        if taken is not None:
            taken.append(out)

    w = feed.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=f"{interval_minutes(interval)} minutes") if ongoing else w.trigger(availableNow=True)
    return w.start()


def drain(*args, **names) -> int:
    """Run ``run_stream`` once after another until a run finds nothing: every page of the feed, in batches of bounded size. Returns the revisions taken."""
    names = {"recent": RecentlySeen(args[0])} | names
    total = 0
    while True:
        taken: list[dict] = []
        run_stream(*args, **names, taken=taken).awaitTermination()
        if not taken:
            return total
        total += sum(x["revisions"] for x in taken)
