"""Queries over the Parquet tables, one per operator, and the same in SQL.

``rev`` views the text corpus as shredded revisions (five per page, four dump files); ``rc`` views
``events`` as feed items. Index queries take the index tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import functions as fn
from palimpsest.operators import framing, index, metadata, shred
from palimpsest.sources.tables import table
from palimpsest.streaming import sync

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# --- the same views in both languages -------------------------------------------------

_REV = """
rev AS (SELECT doc_id + 1 AS rev_id, doc_id // 5 + 1 AS page_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id END AS parent_rev_id,
  ([0, 1, 2, 118])[CAST((doc_id // 5 + 1) % 4 AS INT) + 1] AS ns, 'Page ' || (doc_id // 5 + 1) AS title,
  strftime(timestamp '2024-01-01' + to_minutes(CAST(doc_id AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp",
  doc_id % 7 AS user_id, 'dump-' || ((doc_id // 5 + 1) % 4) || '.xml.bz2' AS file, doc_id AS seq, text FROM documents)"""
_FRAMED = (
    _REV
    + """,
framed AS (SELECT *, 'dump-' || (page_id % 4) || '.xml.mwrev.zst' AS file_path,
  '# page_id=' || page_id || ' ns=' || ns || ' rev_id=' || rev_id || ' parent_rev_id=' || coalesce(CAST(parent_rev_id AS VARCHAR), '') || ' timestamp='
    || "timestamp" || ' user_id=' || user_id || chr(10) AS header,
  CASE WHEN coalesce(text, '') = '' THEN '' ELSE ' ' || replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\\n$', ''), chr(10), chr(10) || ' ') || chr(10) END AS body
  FROM rev)"""
)
_PLACED = (
    _FRAMED
    + """,
placed AS (SELECT *, CAST(strlen(body) AS BIGINT) AS length,
  CAST(-strlen(body) + sum(strlen(header) + strlen(body)) OVER (PARTITION BY file_path ORDER BY seq ROWS UNBOUNDED PRECEDING) AS BIGINT) AS offset_begin FROM framed)"""
)
#: Normalised timestamp of the index in SQL.
_NORM = """CASE WHEN regexp_full_match(revision_timestamp, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2})|\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}')
  THEN TRY_CAST(substr(revision_timestamp, 1, 10) || ' ' || substr(revision_timestamp, 12, 8) AS TIMESTAMP)
    - CASE WHEN regexp_matches(revision_timestamp, '[+-]\\d{2}:\\d{2}$') AND revision_timestamp LIKE '%T%' THEN
      (CASE WHEN right(revision_timestamp, 6)[1] = '-' THEN -1 ELSE 1 END)
      * (to_hours(CAST(substr(right(revision_timestamp, 6), 2, 2) AS INT)) + to_minutes(CAST(right(revision_timestamp, 2) AS INT))) ELSE INTERVAL 0 SECOND END END"""
_SHOWN = f"strftime({_NORM}, '%Y-%m-%dT%H:%M:%SZ')"


def rev(spark: SparkSession, d: str) -> DataFrame:
    """The corpus as shredded revisions."""
    page = F.expr("doc_id div 5 + 1")
    return table(spark, d, "documents").select(
        (F.col("doc_id") + 1).alias("rev_id"), page.alias("page_id"), F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL ELSE doc_id END").alias("parent_rev_id"),
        F.element_at(F.array(*map(F.lit, (0, 1, 2, 118))), (page % 4 + 1).cast("int")).alias("ns"), F.concat(F.lit("Page "), page.cast("string")).alias("title"),
        fn.normalize_timestamp(F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id AS int), 0)"), "yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.expr("doc_id % 7").alias("user_id"), F.concat(F.lit("dump-"), (page % 4).cast("string"), F.lit(".xml.bz2")).alias("file"), F.col("doc_id").alias("seq"), "text",
    )


def framed(spark: SparkSession, d: str) -> DataFrame:
    s = lambda c: F.col(c).cast("string")
    raw = rev(spark, d).select("*", s("page_id").alias("page_raw"), s("ns").alias("ns_raw"), s("rev_id").alias("rev_raw"), F.coalesce(s("parent_rev_id"), F.lit("")).alias("parent_raw"), s("user_id").alias("user_raw"))
    return framing.frame(raw.withColumn("file_path", fn.output_name(F.col("file"))))


def placed(spark: SparkSession, d: str) -> DataFrame:
    """Revisions with their places; the sort columns carry the metadata, so texts stay in their scan."""
    f = framed(spark, d)
    sized = f.select("file_path", "seq", "rev_id", "page_id", "parent_rev_id", "timestamp", fn.byte_length(F.col("header")).alias("_h"), fn.byte_length(F.col("body")).alias("length"))
    return framing.offsets_of_sizes(sized, ["seq"])


def rc(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        F.col("event_id").alias("revid"), F.col("user_id").alias("pageid"), (F.col("event_id") % 5).alias("ns"), F.col("event_type").alias("title"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"), F.col("event_id").alias("seq"),
    )


_RC = """
rc AS (SELECT event_id AS revid, user_id AS pageid, event_id % 5 AS ns, event_type AS title, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", event_id AS seq FROM events)"""


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


# --- archive ----------------------------------------------------------------------------


@query("archive_offsets", f"WITH {_PLACED} SELECT rev_id, file_path, offset_begin, length FROM placed")
def archive_offsets(spark, d):
    return placed(spark, d).select("rev_id", "file_path", "offset_begin", "length")


@query("archive_records", f"WITH {_FRAMED} SELECT rev_id, md5(header || body) AS record_hash FROM framed")
def archive_records(spark, d):
    return framed(spark, d).select("rev_id", F.md5(F.concat("header", "body")).alias("record_hash"))


@query("stdout_records", f"WITH {_FRAMED} SELECT 'stdout' AS file_path, rev_id, strlen(header || body) AS bytes FROM framed")
def stdout_records(spark, d):
    return framed(spark, d).select(F.lit("stdout").alias("file_path"), "rev_id", fn.byte_length(F.concat("header", "body")).alias("bytes"))


@query("ns_filter_revisions", f"WITH {_REV} SELECT rev_id, page_id, ns FROM rev WHERE CAST(ns AS VARCHAR) IN ('0', '118')")
def ns_filter_revisions(spark, d):
    return shred.in_namespaces(rev(spark, d).withColumn("raw", F.col("ns").cast("string")), ["0", "118"], "raw").select("rev_id", "page_id", "ns")


@query("ns_filter_pages", f"WITH {_REV} SELECT DISTINCT page_id, ns, title FROM rev WHERE ns IN (0, 118) AND title <> ''")
def ns_filter_pages(spark, d):
    return shred.in_namespaces(rev(spark, d).withColumn("raw", F.col("ns").cast("string")), ["0", "118"], "raw").filter("title <> ''").select("page_id", "ns", "title").distinct()


@query("pages_once", f"WITH {_REV} SELECT page_id, arg_min(ns, seq) AS ns, arg_min(title, seq) AS title, min(rev_id) AS rev_id FROM rev GROUP BY page_id")
def pages_once(spark, d):
    return index.first_wins(rev(spark, d).select("page_id", "seq", "ns", "title", "rev_id"), ["page_id"], ["seq"]).drop("seq")


@query("page_title_last_wins", "SELECT numeric_page_id, arg_max(url, id) AS url FROM web_resources WHERE numeric_page_id IS NOT NULL GROUP BY 1")
def page_title_last_wins(spark, d):
    rows = table(spark, d, "web_resources").filter("numeric_page_id IS NOT NULL").select("numeric_page_id", "id", "url")
    return index.last_wins(rows, ["numeric_page_id"], ["id"]).drop("id")


_META = """SELECT 'page' AS type, page_id, CAST(arg_min(ns, seq) AS BIGINT) AS ns, arg_min(title, seq) AS title, CAST(NULL AS BIGINT) AS rev_id, CAST(NULL AS BIGINT) AS parent_rev_id,
  CAST(NULL AS VARCHAR) AS file_path, CAST(NULL AS BIGINT) AS offset_begin, CAST(NULL AS BIGINT) AS length, CAST(NULL AS VARCHAR) AS "timestamp" FROM rev {0} GROUP BY page_id
  UNION ALL SELECT 'revision', page_id, NULL, NULL, rev_id, parent_rev_id, file_path, offset_begin, length, "timestamp" FROM placed {0}"""


def _meta(spark, d, where: str | None = None):
    p = index.first_wins(rev(spark, d).select("page_id", "seq", "ns", "title"), ["page_id"], ["seq"])
    r = placed(spark, d)
    return metadata.metadata(p.filter(where) if where else p, r.filter(where) if where else r)


@query("metadata_union", f"WITH {_PLACED} {_META.format('')}")
def metadata_union(spark, d):
    return _meta(spark, d)


@query("metadata_merge", f"WITH {_PLACED}, m AS ({_META.format('')}) SELECT * FROM m")
def metadata_merge(spark, d):
    whole = _meta(spark, d)
    return metadata.merge([whole.filter(F.col("page_id") % 4 == i) for i in range(4)])


@query("output_names", f"WITH {_REV}, f AS (SELECT DISTINCT file FROM rev UNION SELECT unnest(['a.xml', 'b.7z', 'c.xml.7z', 'd.txt', 'e.bz2'])) SELECT file, regexp_replace(file, '\\.(bz2|7z|xml)$', '') || '.mwrev.zst' AS out_name FROM f")
def output_names(spark, d):
    files = rev(spark, d).select("file").distinct().union(spark.createDataFrame([(x,) for x in ("a.xml", "b.7z", "c.xml.7z", "d.txt", "e.bz2")], "file string"))
    return files.select("file", fn.output_name(F.col("file")).alias("out_name"))


@query(
    "default_projection",
    """SELECT doc_id, coalesce(CASE WHEN regexp_full_match(s, '\\+?[0-9]+') THEN TRY_CAST(s AS BIGINT) END, 0) AS rev_id,
  CASE WHEN regexp_full_match(s, '\\+?[0-9]+') THEN TRY_CAST(s AS BIGINT) END AS parent_rev_id,
  coalesce(CASE WHEN regexp_full_match(s, '[+-]?[0-9]+') THEN TRY_CAST(s AS INT) END, 0) AS ns FROM (SELECT doc_id, coalesce(CAST(n_chars AS VARCHAR), lang) AS s FROM documents)""",
)
def default_projection(spark, d):
    s = F.col("s")
    raw = table(spark, d, "documents").select("doc_id", F.coalesce(F.col("n_chars").cast("string"), F.col("lang")).alias("s"))
    return raw.select("doc_id", fn.parse_id(s).alias("rev_id"), fn.parse_id(s, None).alias("parent_rev_id"), fn.parse_ns(s).alias("ns"))


@query("copy_escape", "SELECT doc_id, md5(replace(replace(replace(replace(replace(text, '\\', '\\\\'), chr(9), '\\t'), chr(10), '\\n'), chr(13), '\\r'), chr(0), '')) AS escaped FROM documents")
def copy_escape(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(fn.copy_escape(F.col("text"))).alias("escaped"))


@query("raw_text_lines", "SELECT doc_id, CAST(len(string_split(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\\n$', ''), chr(10))) AS BIGINT) AS n_lines FROM documents WHERE text <> ''")
def raw_text_lines(spark, d):
    b = fn.body(F.col("text"))
    return table(spark, d, "documents").filter("text <> ''").select("doc_id", (F.octet_length(b) - F.octet_length(F.replace(b, F.lit("\n"), F.lit("")))).cast("long").alias("n_lines"))


# --- index ------------------------------------------------------------------------------


@query("url_hash", "SELECT id, md5(url) AS computed, md5(url) = url_hash AS agrees FROM web_resources")
def url_hash(spark, d):
    h = fn.url_hash(F.col("url"))
    return table(spark, d, "web_resources").select("id", h.alias("computed"), (h == F.col("url_hash")).alias("agrees"))


@query("site_domain", "SELECT lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) AS domain, count(*) AS pages FROM web_resources GROUP BY 1")
def site_domain(spark, d):
    return table(spark, d, "web_resources").groupBy(fn.url_host(F.col("url")).alias("domain")).agg(F.count("*").alias("pages"))


@query("page_urls", "SELECT w.id, 'https://' || value || '/w/index.php?curid=' || numeric_page_id AS page_url FROM web_resources w JOIN domains d ON domain_id = d.id WHERE numeric_page_id IS NOT NULL")
def page_urls(spark, d):
    doms = table(spark, d, "domains").select(F.col("id").alias("domain_id"), "value")
    return table(spark, d, "web_resources").filter("numeric_page_id IS NOT NULL").join(doms, "domain_id").select("id", fn.page_url(F.col("value"), F.col("numeric_page_id")).alias("page_url"))


@query("ts_normalize", f"SELECT delivery_id, {_SHOWN} AS normalized FROM revisions")
def ts_normalize(spark, d):
    return table(spark, d, "revisions").select("delivery_id", fn.normalize_timestamp(F.col("revision_timestamp")).alias("normalized"))


@query("latest_timestamp", "SELECT max(revision_timestamp) AS latest FROM revisions")
def latest_timestamp(spark, d):
    return metadata.latest_timestamp(table(spark, d, "revisions"), "revision_timestamp", normalized=False)


@query("latest_timestamp_normalized", f"SELECT max({_SHOWN}) AS latest FROM revisions")
def latest_timestamp_normalized(spark, d):
    return metadata.latest_timestamp(table(spark, d, "revisions"), "revision_timestamp")


@query("resume_window", f"WITH t AS (SELECT delivery_id, {_NORM} AS i FROM revisions) SELECT delivery_id FROM t WHERE i >= (SELECT max(i) FROM t) - INTERVAL 24 HOURS")
def resume_window(spark, d):
    t = table(spark, d, "revisions").select("delivery_id", fn.instant(F.col("revision_timestamp")).alias("i"))
    return t.filter(F.col("i") >= t.agg(F.max("i")).scalar() - int(sync.OVERLAP.total_seconds())).select("delivery_id")


@query("staleness_guard", f"SELECT found_in_bundle, max({_NORM}) < TIMESTAMP '2026-01-01' - INTERVAL 30 DAYS AS stale FROM revisions GROUP BY 1")
def staleness_guard(spark, d):
    limit = int(sync.parse_utc("2026-01-01T00:00:00Z").timestamp() - sync.STALE.total_seconds())
    return table(spark, d, "revisions").groupBy("found_in_bundle").agg((F.max(fn.instant(F.col("revision_timestamp"))) < limit).alias("stale"))


@query("unseen_revisions", "SELECT event_id + 10000000 AS rev_id FROM events WHERE event_id + 10000000 NOT IN (SELECT revision_id FROM revisions WHERE found_in_bundle IS NOT NULL AND revision_id IS NOT NULL)")
def unseen_revisions(spark, d):
    return index.unseen(table(spark, d, "events").select((F.col("event_id") + 10000000).alias("rev_id")), table(spark, d, "revisions"))


@query("bundle_keys", "SELECT file_path, row_number() OVER (ORDER BY file_path) AS id FROM (SELECT DISTINCT file_path FROM revision_bundles)")
def bundle_keys(spark, d):
    return index.next_ids(table(spark, d, "revision_bundles"), "file_path")


@query("revisions_with_bundle", "SELECT delivery_id, revision_id, file_path FROM revisions LEFT JOIN revision_bundles b ON found_in_bundle = b.id")
def revisions_with_bundle(spark, d):
    b = table(spark, d, "revision_bundles").withColumnRenamed("id", "found_in_bundle")
    return table(spark, d, "revisions").join(b, "found_in_bundle", "left").select("delivery_id", "revision_id", "file_path")


@query(
    "domain_keys",
    """WITH n AS (SELECT DISTINCT regexp_extract(file_path, '^[^/-]+', 0) AS value FROM revision_bundles UNION SELECT lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)) FROM web_resources)
  SELECT id, value FROM domains UNION ALL SELECT row_number() OVER (ORDER BY value) + (SELECT coalesce(max(id), 0) FROM domains), value FROM n WHERE value NOT IN (SELECT value FROM domains)""",
)
def domain_keys(spark, d):
    """Domains, with what URLs and archive names mention beyond them."""
    named = table(spark, d, "revision_bundles").select(F.regexp_extract("file_path", "^[^/-]+", 0).alias("value"))
    hosts = table(spark, d, "web_resources").select(fn.url_host(F.col("url")).alias("value"))
    return index.grow_dimension(table(spark, d, "domains"), named.unionByName(hosts), "value").select("id", "value")


@query("documents_distinct", "SELECT DISTINCT title FROM document_index")
def documents_distinct(spark, d):
    return table(spark, d, "document_index").select("title").distinct()


@query(
    "documents_insert",
    """WITH old AS (SELECT min(id) AS id, title FROM document_index WHERE language_code IS NOT NULL GROUP BY title),
  n AS (SELECT DISTINCT title FROM document_index WHERE language_code IS NULL AND title NOT IN (SELECT title FROM old))
  SELECT id, title FROM old UNION ALL SELECT (SELECT coalesce(max(id), 0) FROM old) + row_number() OVER (ORDER BY title), title FROM n""",
)
def documents_insert(spark, d):
    """Titles with a language stand in the index, those without come in: each title once."""
    t = table(spark, d, "document_index").select("id", "title", "language_code")
    old = index.first_wins(t.filter("language_code IS NOT NULL").select("id", "title"), ["title"], ["id"])
    return index.grow_dimension(old, t.filter("language_code IS NULL"), "title").select("id", "title")


@query(
    "web_resources_upsert",
    """WITH n AS (SELECT md5(url) AS url_hash, url, page_id, ns FROM (SELECT 'https://' || (SELECT value FROM domains WHERE id = 1) || '/w/index.php?curid=' || page_id AS url, page_id, arg_max(length % 16, delivery_id) AS ns
    FROM revisions WHERE page_id <> 0 GROUP BY page_id))
  SELECT coalesce(o.url_hash, n.url_hash) AS url_hash, coalesce(n.url, o.url) AS url, CASE WHEN n.url IS NULL THEN o.numeric_page_id ELSE n.page_id END AS numeric_page_id,
  CASE WHEN n.url IS NULL THEN o.numeric_namespace_id ELSE n.ns END AS numeric_namespace_id, o.instance_of_document FROM web_resources o FULL JOIN n ON o.url_hash = n.url_hash""",
)
def web_resources_upsert(spark, d):
    """Every page of the log, as its last delivery has it, merged into the resources; document links stay."""
    domain = table(spark, d, "domains").filter("id = 1").select("value").scalar()
    url = fn.page_url(domain, F.col("page_id"))
    new = table(spark, d, "revisions").filter("page_id <> 0").select("page_id", url.alias("url"), (F.col("length") % 16).alias("numeric_namespace_id"), F.col("delivery_id").alias("seq"))
    new = index.last_wins(new, ["page_id", "url"], ["seq"]).select(
        "url", fn.url_hash(F.col("url")).alias("url_hash"), F.col("page_id").alias("numeric_page_id"), "numeric_namespace_id", F.lit(None).cast("long").alias("instance_of_document"), "seq"
    )
    old = table(spark, d, "web_resources").select("url_hash", "url", "numeric_page_id", "numeric_namespace_id", "instance_of_document")
    return index.upsert(old, new, "url_hash", ["seq"], keep=["instance_of_document"])


@query(
    "revisions_insert_ignore",
    """WITH p AS (SELECT coalesce(max(batch_to), 0) AS p FROM sync_runs WHERE status = 'succeeded'),
  old AS (SELECT revision_id, min(delivery_id) AS delivery_id, arg_min(length, delivery_id) AS length FROM revisions WHERE revision_id IS NOT NULL AND batch_id <= (SELECT p FROM p) GROUP BY 1),
  new AS (SELECT revision_id, min(delivery_id) AS delivery_id, arg_min(length, delivery_id) AS length FROM revisions WHERE revision_id IS NOT NULL AND batch_id > (SELECT p FROM p) GROUP BY 1)
  SELECT * FROM old UNION ALL SELECT * FROM new WHERE revision_id NOT IN (SELECT revision_id FROM old)""",
)
def revisions_insert_ignore(spark, d):
    """What succeeded runs brought stands in the index, later batches come in: the first row of a revision stays."""
    at = table(spark, d, "sync_runs").filter("status = 'succeeded'").agg(F.coalesce(F.max("batch_to"), F.lit(0))).scalar()
    t = table(spark, d, "revisions").filter("revision_id IS NOT NULL").select("revision_id", "delivery_id", "length", "batch_id")
    old = index.first_wins(t.filter(F.col("batch_id") <= at).drop("batch_id"), ["revision_id"], ["delivery_id"])
    return index.insert_ignore(old, t.filter(F.col("batch_id") > at), "revision_id", ["delivery_id"]).select("revision_id", "delivery_id", "length")


@query(
    "document_fk_backfill",
    """WITH t AS (SELECT title, min(id) AS document_id FROM document_index WHERE title IS NOT NULL GROUP BY 1),
  p AS (SELECT DISTINCT w.domain_id, w.numeric_page_id, t.document_id FROM (SELECT domain_id, numeric_page_id, arg_max(title, x.id) AS title FROM web_resources x JOIN document_index i ON i.id = x.id WHERE numeric_page_id IS NOT NULL GROUP BY 1, 2) w JOIN t USING (title))
  SELECT w.id, coalesce(w.instance_of_document, p.document_id) AS instance_of_document FROM web_resources w LEFT JOIN p ON w.domain_id = p.domain_id AND w.numeric_page_id = p.numeric_page_id""",
)
def document_fk_backfill(spark, d):
    w, docs = table(spark, d, "web_resources"), table(spark, d, "document_index")
    pages = w.filter("numeric_page_id IS NOT NULL").join(docs.select("id", "title"), "id").select("domain_id", F.col("numeric_page_id").alias("page_id"), "title", F.col("id").alias("seq"))
    return index.backfill_documents(w, pages, docs).select("id", "instance_of_document")


@query("missing_tables", "SELECT unnest(['containers']) AS missing")
def missing_tables(spark, d):
    from palimpsest.session import exists

    names = ["containers", "domains", "document_index", "web_resources", "revision_bundles", "revisions"]
    missing = index.missing_tables(names, lambda n: exists(spark, f"{d}/{n}.parquet"))
    return spark.createDataFrame([(n,) for n in missing], "missing string")


@query("enrich_revisions", f"WITH {_REV}, {_RC.strip()} SELECT revid, rev.page_id, rev.title FROM rc JOIN rev ON rev.rev_id = rc.revid")
def enrich_revisions(spark, d):
    return rc(spark, d).select("revid").join(rev(spark, d).select(F.col("rev_id").alias("revid"), "page_id", "title"), "revid")


# --- feed -------------------------------------------------------------------------------


@query("feed_valid", f"WITH {_RC} SELECT revid, pageid, ns FROM rc WHERE pageid IS NOT NULL AND ns IN (0, 2) AND title IS NOT NULL AND revid > 0 AND \"timestamp\" <> ''")
def feed_valid(spark, d):
    return sync.valid_items(rc(spark, d), ["0", "2"]).filter("revid > 0 AND timestamp <> ''").select("revid", "pageid", "ns")


@query("feed_pages", f"WITH {_RC} SELECT pageid, arg_max(title, seq) AS title FROM rc WHERE ns IN (0, 2) GROUP BY 1")
def feed_pages(spark, d):
    return index.last_wins(sync.valid_items(rc(spark, d), ["0", "2"]).select("pageid", "seq", "title"), ["pageid"], ["seq"]).drop("seq")


@query("daily_rotation", f"WITH {_RC} SELECT 'recentchanges/' || substr(\"timestamp\", 1, 10) || '.mwrev.zst' AS file_path, count(*) AS n FROM rc GROUP BY 1")
def daily_rotation(spark, d):
    return rc(spark, d).groupBy(fn.daily_path(F.col("timestamp")).alias("file_path")).agg(F.count("*").alias("n"))


@query("feed_json", f"WITH {_RC} SELECT revid, pageid, ns, title, \"timestamp\", CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM rc JOIN events ON event_id = revid")
def feed_json(spark, d):
    """Feed replies of one item each, parsed by the feed's own paths, and a number of the events' properties."""
    from palimpsest.sources.changes import parse_feed

    item = F.to_json(F.struct("revid", "pageid", "ns", "title", "timestamp"))
    replies = rc(spark, d).select(F.concat(F.lit('{"query": {"recentchanges": ['), item, F.lit("]}}")).alias("value"))
    k = table(spark, d, "events").select(F.col("event_id").alias("revid"), F.get_json_object("props", "$.k").try_cast("long").alias("k"))
    return parse_feed(replies).join(k, "revid")


@query(
    "feed_contents",
    f"""WITH {_REV} SELECT rev_id, coalesce(parent_rev_id, 0) AS parent_rev_id, page_id, ns, user_id, "timestamp", md5(coalesce(text, '')) AS text_hash FROM rev WHERE ns IN (0, 118)""",
)
def feed_contents(spark, d):
    """Content replies, half with an array of pages and half with a map, parsed back to revisions."""
    from palimpsest.sources.changes import contents

    r = rev(spark, d)
    slots = F.struct(F.struct(F.col("text").alias("content")).alias("main"))
    one = F.struct(F.col("rev_id").alias("revid"), F.col("parent_rev_id").alias("parentid"), F.col("timestamp"), F.col("user_id").alias("userid"), slots.alias("slots"))
    page = F.to_json(F.struct("ns", F.col("page_id").alias("pageid"), F.array(one).alias("revisions")))
    whole = F.when(F.col("rev_id") % 2 == 0, F.concat(F.lit("["), page, F.lit("]"))).otherwise(F.concat(F.lit('{"'), F.col("page_id").cast("string"), F.lit('": '), page, F.lit("}")))
    replies = r.select(F.concat(F.lit('{"query": {"pages": '), whole, F.lit("}}")).alias("value"))
    return contents(replies, ["0", "118"]).select("rev_id", "parent_rev_id", "page_id", "ns", "user_id", "timestamp", F.md5("text").alias("text_hash"))


@query("fetch_chunks", "SELECT (event_id // 50) AS chunk, string_agg(CAST(event_id AS VARCHAR), '|' ORDER BY event_id) AS revids FROM events GROUP BY 1")
def fetch_chunks(spark, d):
    return table(spark, d, "events").groupBy(F.expr("event_id div 50").alias("chunk")).agg(fn.joined_ids(F.collect_list("event_id")).alias("revids"))


@query("batch_high_water", "SELECT (event_id // 500) AS page, strftime(arg_max(ts, event_id), '%Y-%m-%dT%H:%M:%SZ') AS last_ts FROM events GROUP BY 1")
def batch_high_water(spark, d):
    return sync.batch_high_water(rc(spark, d), "seq", "timestamp")


def _streamed(spark, d, name, build, key):
    """Drain a stream over ``events`` into a table of the shared folder, then read it."""
    from palimpsest.session import scratch

    src = table(spark, d, "events")
    path = scratch(spark, name)
    stream = spark.readStream.schema(src.schema).option("pathGlobFilter", "events.parquet").parquet(d)
    q = build(stream).writeStream.format("parquet").option("path", path).option("checkpointLocation", path + "-state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(path).select(*key)


@query("stream_dedup_25h", "SELECT DISTINCT user_id FROM events")
def stream_dedup_25h(spark, d):
    return _streamed(spark, d, "dedup", lambda s: sync.drop_recent(s.withColumn("ts", F.to_timestamp("ts")), "user_id").select("user_id"), ["user_id"])


@query(
    "stream_daily_append",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1
  HAVING CAST(strftime(any_value(ts), '%Y-%m-%d') AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 25 HOURS""",
)
def stream_daily_append(spark, d):
    """Events per day, each day once, when the watermark has passed its end."""
    daily = lambda s: s.withColumn("ts", F.to_timestamp("ts")).withWatermark("ts", "25 hours").groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n"))
    return _streamed(spark, d, "daily", lambda s: daily(s).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n"), ["day", "n"])


def _mounted(spark, name: str) -> tuple[str, str]:
    """(path, the same as a local path) of a scratch folder that Python code writes to."""
    from palimpsest.session import fs, scratch

    root = scratch(spark, name)
    f, p = fs(spark, root)
    if f.getUri().getScheme() != "file":
        raise ValueError("archives and recorded replies need a mounted file system")
    return root, p.toUri().getPath()


_PRINTED = "regexp_replace(coalesce(text, ''), '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')"
_CLEAN = f"CASE WHEN regexp_full_match({_PRINTED}, '\\s*') THEN '' ELSE {_PRINTED} END"  # blanks alone are no text to the XML reader
_ROUNDTRIP = _PLACED.replace("doc_id AS seq, text FROM documents)", f"doc_id AS seq, {_CLEAN} AS text FROM documents)")


@query(
    "xml_roundtrip",
    f"WITH {_ROUNDTRIP} SELECT rev_id, page_id, file_path, offset_begin, length, md5(regexp_replace(text, '\\n$', '')) AS text_hash FROM placed",
)
def xml_roundtrip(spark, d):
    """Corpus to dump XML (four files, packed by bz2), built into archives and read again: every text with its page and place."""
    import os

    from palimpsest.plans.build import build
    from palimpsest.sources.mwrev import read_archive, unframe

    _, local = _mounted(spark, "xml")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    printed = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    clean = F.when(printed.rlike(r"^\s*$"), F.lit("")).otherwise(printed)
    tag = lambda name, c: F.coalesce(F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>")), F.lit(""))
    page = F.concat(F.lit("<page>"), tag("title", esc(F.col("title"))), tag("ns", F.col("ns")), tag("id", F.col("page_id")))
    revision = F.concat(
        F.lit("<revision>"), tag("id", F.col("rev_id")), tag("parentid", F.col("parent_rev_id")), tag("timestamp", F.col("timestamp")),
        F.lit("<contributor>"), tag("id", F.col("user_id")), F.lit('</contributor><text xml:space="preserve">'), esc(clean), F.lit("</text></revision>"),
    )
    r = rev(spark, d).select("file", "seq", "page_id", page.alias("page"), revision.alias("revision"))

    def write(batches):
        import bz2
        import uuid

        import pandas as pd

        os.makedirs(f"{local}/in", exist_ok=True)
        out, name, last, part = None, None, None, None

        def close():
            out.write("</page>\n</mediawiki>\n")
            out.close()
            os.replace(part, f"{local}/in/{name}")

        for pdf in batches:
            for file, page_id, head, text in pdf[["file", "page_id", "page", "revision"]].itertuples(index=False, name=None):
                if file != name:
                    if out:
                        close()
                    name, last, part = file, None, f"{local}/in/{file}.{uuid.uuid4().hex}.part"
                    out = bz2.open(part, "wt", encoding="utf-8", newline="")
                    out.write("<mediawiki><siteinfo><base>https://en.wikipedia.org/wiki/Main</base></siteinfo>\n")
                if page_id != last:
                    out.write(("</page>\n" if last is not None else "") + head)
                    last = page_id
                out.write(text)
        if out:
            close()
        yield pd.DataFrame({"done": [1]})

    r.repartition("file").sortWithinPartitions("file", "seq").drop("seq").mapInPandas(write, "done long").collect()  # a row a task
    build(spark, f"{local}/in", f"{local}/out", preserve_text=True)
    back = read_archive(spark, f"{local}/out")
    n = lambda c: F.col(c).cast("long").alias(c)
    return back.select(n("rev_id"), n("page_id"), F.col("file").alias("file_path"), "offset_begin", "length", F.md5(unframe(F.col("body"))).alias("text_hash"))


@query("feed_replay", f"WITH {_RC} SELECT revid, pageid, ns, title, \"timestamp\" FROM rc WHERE ns IN (0, 2)")
def feed_replay(spark, d):
    """The events as recorded feed pages of 500 items each, followed to the end by the streaming source, one run after another."""
    import os

    from palimpsest.sources.changes import ITEM_SCHEMA, PAGE_SIZE, register

    root, local = _mounted(spark, "replay")
    os.makedirs(local, exist_ok=True)
    items = rc(spark, d).withColumn("page", F.expr(f"(seq - 1) div {PAGE_SIZE}")).repartitionByRange("page")
    item = F.to_json(F.struct("revid", "pageid", "ns", "title", "timestamp"))
    pages = items.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("seq", item.alias("item")))).alias("x"))
    line = F.concat(F.lit('{"query": {"recentchanges": ['), F.array_join(F.transform("x", lambda x: x["item"]), ", "), F.lit("]}}"))
    # One recorded session is one folder: its parts are ranges, in the order of their names.
    pages.select("page", line.alias("value")).sortWithinPartitions("page").select("value").write.option("compression", "gzip").text(f"{root}/replies")
    register(spark)
    start = "1970-01-01T00:00:00Z"
    stream = spark.readStream.format("recentchanges").option("start", start).option("replay", f"{local}/replies").load()
    while True:
        got = []

        def each(batch, epoch, got=got):
            got.append(epoch)
            batch.write.mode("overwrite").parquet(f"{root}/rows/epoch={epoch}")

        run = stream.writeStream.foreachBatch(each).option("checkpointLocation", f"{root}/state").start()
        try:
            run.processAllAvailable()  # a run once takes one batch, and starting one costs more than a batch
        finally:
            run.stop()
        if not got:
            break
    rows = spark.read.schema(ITEM_SCHEMA).option("basePath", f"{root}/rows").parquet(f"{root}/rows") if os.path.isdir(f"{local}/rows") else spark.createDataFrame([], ITEM_SCHEMA)
    return sync.valid_items(rows, ["0", "2"]).select("revid", "pageid", "ns", "title", "timestamp")


_DAILY = """
day AS (SELECT doc_id % 3 AS turn, doc_id + 1 AS rev_id, CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id END AS parent_rev_id, doc_id // 5 + 1 AS page_id,
  strftime(timestamp '2024-01-01' + to_minutes(CAST(doc_id % 4000 AS INT)), '%Y-%m-%dT%H:%M:%SZ') AS "timestamp", doc_id % 7 AS user_id, text FROM documents),
made AS (SELECT *, 'recentchanges/' || substr("timestamp", 1, 10) || '.mwrev.zst' AS file_path,
  '# page_id=' || page_id || ' ns=0 rev_id=' || rev_id || ' parent_rev_id=' || parent_rev_id || ' timestamp=' || "timestamp" || ' user_id=' || user_id || chr(10) AS header,
  CASE WHEN coalesce(text, '') = '' THEN '' ELSE ' ' || replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\\n$', ''), chr(10), chr(10) || ' ') || chr(10) END AS body FROM day)"""


@query(
    "daily_archive",
    f"""WITH {_DAILY} SELECT rev_id, file_path, CAST(strlen(body) AS BIGINT) AS length,
  CAST(-strlen(body) + sum(strlen(header) + strlen(body)) OVER (PARTITION BY file_path ORDER BY turn, "timestamp", rev_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS offset_begin FROM made""",
)
def daily_archive(spark, d):
    """The corpus as three micro-batches of the feed, each taken twice, appended to daily archives: places as the index has them."""
    _, local = _mounted(spark, "daily")
    at = F.date_format(F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(doc_id % 4000 AS int), 0)"), "yyyy-MM-dd HH:mm:ss")
    made = table(spark, d, "documents").select(
        F.expr("doc_id % 3").alias("turn"), (F.col("doc_id") + 1).alias("rev_id"), F.expr("CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id END").alias("parent_rev_id"),
        F.expr("doc_id div 5 + 1").alias("page_id"), F.lit(0).alias("ns"), F.expr("doc_id % 7").alias("user_id"), fn.normalize_timestamp(at).alias("timestamp"), F.coalesce("text", F.lit("")).alias("text"),
    )
    store = index.IndexStore(spark, f"file://{local}/index")
    for turn in (0, 0, 1, 1, 2, 2):
        feed = made.filter(F.col("turn") == turn).select(F.col("rev_id").alias("revid"), F.col("page_id").alias("pageid"), F.col("ns").cast("long").alias("ns"), F.concat(F.lit("Page "), F.col("page_id").cast("string")).alias("title"), "timestamp")
        sync.process_batch(spark, feed, lambda ids: made.drop("turn").join(ids, "rev_id", "left_semi"), store, "en.wiki.example", local)
    bundles = store.read("revision_bundles").withColumnRenamed("id", "found_in_bundle")
    return store.read("revisions").join(bundles, "found_in_bundle").select(F.col("revision_id").alias("rev_id"), "file_path", "offset_begin", "length")
