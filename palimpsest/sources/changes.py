"""The recent-changes feed: reply parsing, a paging client and a streaming source around it."""

from __future__ import annotations

import gzip
import json
import logging
import os
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from palimpsest import schema

LOG = logging.getLogger(__name__)
PAGE_SIZE, CONTENT_CHUNK = 500, 50
ITEM_SCHEMA = "revid long, pageid long, ns long, title string, timestamp string"


def user_agent() -> str:
    e = os.environ.get
    return f"{e('UA_APP_NAME', 'palimpsest')}/{e('UA_APP_VERSION', '0.1')} ({e('UA_CONTACT_INFO', 'no contact given')})"


def http_get(domain: str, params: dict[str, str]) -> dict:
    url = f"https://{domain}/w/api.php?{urllib.parse.urlencode(params)}"
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": user_agent()}), timeout=60) as r:  # noqa: S310
        return json.load(r)


def feed_params(start: str, namespaces: list[str] | None = None, token: str | None = None) -> dict[str, str]:
    """Request for one feed page; columns, order and namespaces are pushed into it."""
    p = {
        "action": "query", "list": "recentchanges", "rcdir": "newer", "rclimit": str(PAGE_SIZE), "rcstart": start,
        "rcprop": "ids|timestamp|title|userid|ns", "format": "json", "formatversion": "2",
    }
    return p | ({"rcnamespace": "|".join(namespaces)} if namespaces else {}) | ({"rccontinue": token} if token else {})


def content_params(ids: list[int]) -> dict[str, str]:
    return {
        "action": "query", "prop": "revisions", "revids": "|".join(map(str, ids)), "rvprop": "ids|timestamp|user|content|userid|flags",
        "rvslots": "main", "format": "json", "formatversion": "2",
    }


def feed_pages(fetch: Callable[[dict], dict], start: str, namespaces: list[str] | None = None, token: str | None = None) -> Iterator[tuple[list[dict], str | None]]:
    """Follow the continuation token; ends at a reply that is empty or has no token. A reply without ``query`` raises."""
    while True:
        reply = fetch(feed_params(start, namespaces, token))
        if "query" not in reply:
            raise RuntimeError(f"feed reply without query: {str(reply)[:200]}")
        items = reply["query"].get("recentchanges")
        if not isinstance(items, list) or not items:
            return
        token = (reply.get("continue") or {}).get("rccontinue")
        yield items, token
        if not token:
            return


class Recording:
    """Recorded replies, one JSON a line: feed pages, whose continuation token is the number of the next page, and contents, found by revision.

    ``path`` is a file, or a folder whose files follow each other by name; those named .gz are unpacked. Pages whose items are all older than the start are
    passed over, as the interface does. A line is parsed when the way comes to it, and its place is kept: a step costs one page, however long the recording is.
    Places are forgotten when a file changes, and found again where a copy is sent to.
    """

    def __init__(self, path: str):
        self.path, self.files, self.file = path, None, (None, None)

    def __reduce__(self):
        return type(self), (self.path,)

    def _look(self) -> None:
        if os.path.isdir(self.path):
            names = [os.path.join(self.path, x) for x in sorted(os.listdir(self.path)) if x[0] not in "._"]
        else:
            names = [self.path]
        files = [(x, s.st_size, s.st_mtime_ns) for x in names for s in [os.stat(x)]]
        if files != self.files:
            self.files, self.lines = files, self._lines(names)
            self.pages: list[tuple[str, int, str | None]] = []  # of each feed page: file, place, newest instant
            self.held: dict[int, dict[tuple[str, int], None]] = {}  # places of a revision's contents
            self.parsed: tuple[int, dict] = (-1, {})  # the page that was come to last
            self.way: tuple[str, list[int], int] = ("", [], 0)  # start, pages not older, pages looked at
            self._close()

    def _close(self) -> None:
        if self.file[1]:
            self.file[1].close()
        self.file = (None, None)

    @staticmethod
    def _open(name: str):
        return gzip.open(name) if name.endswith(".gz") else open(name, "rb")  # noqa: SIM115

    def _lines(self, names: list[str]) -> Iterator[tuple[str, int, bytes]]:
        for name in names:
            with self._open(name) as f:
                at = 0
                for line in f:
                    if line.strip():
                        yield name, at, line
                    at += len(line)

    def _next(self) -> bool:
        """Go on to the next feed page; False at the end."""
        for name, at, line in self.lines:
            query = (reply := json.loads(line)).get("query", {})
            for p in query.get("pages", []):
                for v in p.get("revisions", []):
                    self.held.setdefault(v["revid"], {})[name, at] = None
            if "recentchanges" in query:
                self.parsed = (len(self.pages), reply)
                self.pages.append((name, at, max((x.get("timestamp") or "~" for x in query["recentchanges"]), default=None)))
                return True
        return False

    def _reply(self, name: str, at: int) -> dict:
        """The reply at a place. Its file stays open, as the next one asked for mostly stands behind it."""
        if self.file[0] != name:
            self._close()
            self.file = (name, self._open(name))
        self.file[1].seek(at)
        return json.loads(self.file[1].readline())

    def _page(self, start: str, n: int) -> int | None:
        """Number of the ``n``-th page (from 0) that is not older than ``start``; None beyond the last."""
        _, found, seen = self.way if self.way[0] == start else (start, [], 0)
        while len(found) <= n and (seen < len(self.pages) or self._next()):
            newest = self.pages[seen][2]
            if newest is not None and newest >= start:
                found.append(seen)
            seen += 1
        self.way = (start, found, seen)
        return found[n] if n < len(found) else None

    def __call__(self, params: dict) -> dict:
        self._look()
        if params.get("list") == "recentchanges":
            start, n = params["rcstart"], int(params.get("rccontinue", 0))
            if (k := self._page(start, n)) is None:
                return {"query": {"recentchanges": []}}
            reply = self.parsed[1] if self.parsed[0] == k else self._reply(*self.pages[k][:2])
            items = [x for x in reply["query"]["recentchanges"] if (x.get("timestamp") or "~") >= start]
            return {"query": {"recentchanges": items}} | ({"continue": {"rccontinue": str(n + 1)}} if self._page(start, n + 1) is not None else {})
        while self._next():
            pass
        wanted = set(map(int, params["revids"].split("|")))
        places = sorted({x for i in wanted for x in self.held.get(i, ())})
        pages = [p for x in places for p in self._reply(*x)["query"]["pages"]]
        return {"query": {"pages": [p | {"revisions": found} for p in pages if (found := [v for v in p.get("revisions", []) if v["revid"] in wanted])]}}


def replayed(path: str) -> Callable[[dict], dict]:
    """``Recording`` in place of the live interface."""
    return Recording(path)


#: Feed pages a micro-batch takes at most, 500 changes each: what the driver and a day's archive task hold at once.
PAGES_PER_BATCH = 100


class ChangesReader(SimpleDataSourceStreamReader):
    """Offset: where the way through the pages began, its continuation token, the last instant seen and how many rows had it, and how many had none (if any).

    A read follows the pages to their end, or takes ``pagesperbatch`` of them and goes on from there in the next batch. At the end the next way begins
    at the last instant, inclusive; it gives rows only if there are more than before, for which all pages of that instant are looked through. Rows read
    are cached by Spark for replays of a batch.
    """

    def __init__(self, options: dict, fetch: Callable[[dict], dict] | None = None):
        self.start, self.namespaces = options["start"], [x for x in options.get("namespaces", "").split(",") if x] or None
        replay, self.most = options.get("replay"), int(options.get("pagesperbatch", PAGES_PER_BATCH))
        self.fetch = fetch or (replayed(replay) if replay else lambda p: http_get(options["domain"], p))

    def initialOffset(self):
        return {"start": self.start, "token": "", "last": self.start, "rows": 0}

    def _rows(self, items):
        return [tuple(x.get(k) for k in ("revid", "pageid", "ns", "title", "timestamp")) for x in items]

    def _pages(self, start):
        """(rows, offset after them) of each page from an offset on."""
        last, rows, bare = (start["last"], start["rows"], start.get("bare", 0)) if start["token"] else (start["start"], 0, 0)
        for items, token in feed_pages(self.fetch, start["start"], self.namespaces, start["token"] or None):
            stamps = [x.get("timestamp") or "" for x in items]
            top = max(last, *stamps)
            rows = (rows if top == last else 0) + stamps.count(top)
            last, bare = top, bare + stamps.count("")
            seen = {"last": last, "rows": rows} | ({"bare": bare} if bare else {})
            yield self._rows(items), {"start": start["start"], "token": token} | seen if token else {"start": last, "token": ""} | seen

    def read(self, start):
        rows, at, pages = [], start, self._pages(start)
        for got, at in islice(pages, self.most):
            rows += got
        # A way that begins again may need more pages than a batch to pass what was known.
        known = lambda x: x["last"] == start["last"] and x["rows"] <= start["rows"] and x.get("bare", 0) <= start.get("bare", 0)
        end = at
        while not start["token"] and end["token"] and known(end) and (more := next(pages, None)):
            end = more[1]
        return iter(rows if end != start else []), start if end == start else at

    def readBetweenOffsets(self, start, end):
        rows, at = [], start
        while at != end:
            before = at
            for got, at in self._pages(before):
                rows += got
                if at == end:
                    break
            if at == before:
                break
        return iter(rows)

    def commit(self, end):
        pass


class ArrowChangesReader(ChangesReader):
    """Gives its rows in one Arrow batch: Spark converts tuples value by value."""

    def read(self, start):
        rows, at = super().read(start)
        return self._batches(rows), at

    def readBetweenOffsets(self, start, end):
        return self._batches(super().readBetweenOffsets(start, end))

    def _batches(self, rows):
        import pyarrow as pa

        rows = list(rows)
        kinds = [(name, pa.int64() if kind == "long" else pa.string()) for name, kind in (x.split() for x in ITEM_SCHEMA.split(", "))]
        try:
            return iter([pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], pa.schema(kinds))] if rows else [])
        except (pa.ArrowException, TypeError, OverflowError):  # values of other kinds: Spark converts or rejects them
            return iter(rows)


class ChangesSource(DataSource):
    """``spark.readStream.format("recentchanges").option("domain", ...).option("start", ...)``; ``replay`` names a file or folder of recorded replies."""

    @classmethod
    def name(cls):
        return "recentchanges"

    def schema(self):
        return ITEM_SCHEMA

    def simpleStreamReader(self, schema):
        return ArrowChangesReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the source known. Its code travels with it: the process that reads a stream's offsets does not get the files sent to workers."""
    import sys

    from pyspark.cloudpickle import register_pickle_by_value

    register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(ChangesSource)


def parse_feed(replies: DataFrame, column: str = "value") -> DataFrame:
    """Items of JSON feed replies, one row each; malformed or empty replies give none."""
    q = F.from_json(F.col(column), schema.FEED)
    return replies.select(F.explode(q["query"]["recentchanges"]).alias("c")).select("c.*")


def parse_content(reply: Column) -> Column:
    """``query.pages`` as an array of pages, whether the reply has an array or a map of them."""
    pages = F.get_json_object(reply, "$.query.pages")
    array = F.when(pages.startswith("["), F.from_json(pages, F.lit(f"array<{schema.CONTENT_PAGE.simpleString()}>")))
    keyed = F.when(pages.startswith("{"), F.map_values(F.from_json(pages, F.lit(f"map<string,{schema.CONTENT_PAGE.simpleString()}>"))))
    return F.coalesce(array, keyed)


def contents(replies: DataFrame, namespaces: list[str] | None = None, column: str = "value") -> DataFrame:
    """Revisions of content replies with their defaults (0 and '').

    Rows with revision 0 or an empty timestamp, or outside the namespaces, are dropped.
    """
    p = replies.select(F.explode(parse_content(F.col(column))).alias("p")).select(
        F.coalesce("p.ns", F.lit(0)).cast("int").alias("ns"), F.coalesce("p.pageid", F.lit(0)).cast("long").alias("page_id"), F.explode("p.revisions").alias("r")
    )
    if namespaces is not None:
        p = p.filter(F.col("ns").cast("string").isin(namespaces))
    z, e = F.lit(0).cast("long"), F.lit("")
    return p.select(
        F.coalesce("r.revid", z).alias("rev_id"), F.coalesce("r.parentid", z).alias("parent_rev_id"), "page_id", "ns",
        F.coalesce("r.userid", z).alias("user_id"), F.coalesce("r.timestamp", e).alias("timestamp"), F.coalesce("r.slots.main.content", e).alias("text"),
    ).filter("rev_id <> 0 AND timestamp <> ''")


def fetch_contents(ids: DataFrame, domain: str, fetch: Callable[[dict], dict] | None = None) -> DataFrame:
    """Look up revision contents, 50 ids a request, from the executors; returns the raw replies."""
    get = fetch or (lambda p: http_get(domain, p))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            all_ids = pdf["rev_id"].tolist()
            for i in range(0, len(all_ids), CONTENT_CHUNK):
                LOG.info("fetching content of %d revisions", len(all_ids[i : i + CONTENT_CHUNK]))
                yield pd.DataFrame({"value": [json.dumps(get(content_params(all_ids[i : i + CONTENT_CHUNK])))]})

    return ids.select("rev_id").mapInPandas(run, "value string")
