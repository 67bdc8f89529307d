"""Queries of the record operators over the revision log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import instant
from palimpsest.operators import hierarchy as tree
from palimpsest.operators import skew
from palimpsest.operators.dedup import DedupIndex, repeats
from palimpsest.operators.incremental import MerkleStore
from palimpsest.operators.orphans import orphan_references
from palimpsest.plans.catalogue import _NORM
from palimpsest.session import scratch, stage
from palimpsest.sources.tables import table

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

_USABLE = f"u AS (SELECT *, {_NORM} AS i FROM revisions WHERE revision_id <> 0)"


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def log(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    """Usable rows of the log."""
    return table(spark, d, "revisions").filter("revision_id <> 0").select(*columns)


def position(spark: SparkSession, d: str) -> int | None:
    """Highest batch that a succeeded run covers; None before any."""
    return table(spark, d, "sync_runs").filter("status = 'succeeded'").agg(F.max("batch_to")).first()[0]


@query(
    "p1_found",
    f"""WITH {_USABLE}, p AS (SELECT max(batch_to) AS p FROM sync_runs WHERE status = 'succeeded'),
  s AS (SELECT revision_id, i, coalesce(batch_id <= p, false) AS old FROM u, p), b AS (SELECT DISTINCT revision_id FROM s WHERE old)
  SELECT DISTINCT revision_id, 'added' AS change_kind FROM s WHERE NOT old AND revision_id NOT IN (SELECT revision_id FROM b)
  UNION ALL SELECT DISTINCT revision_id, 'changed' FROM s WHERE NOT old AND i IS NOT NULL AND revision_id IN (SELECT revision_id FROM b)
    AND NOT EXISTS (SELECT 1 FROM s o WHERE o.old AND o.revision_id = s.revision_id AND o.i = s.i)""",
)
def p1_found(spark, d):
    """The state that succeeded runs published, then one run over the whole log."""
    at = position(spark, d)
    rows = log(spark, d, "revision_id", "batch_id", instant(F.col("revision_timestamp")).alias("instant"))
    store = MerkleStore(spark, scratch(spark, "merkle"))
    key, version = F.col("revision_id"), F.col("instant")
    if at is not None:
        store.sync(rows.filter(F.col("batch_id") <= at), key, version)
    return store.sync(rows, key, version).select(F.col("key").alias("revision_id"), "change_kind")


#: Roots and depths; then every key's way down from its root, cycles cut above their least key, and its place in the tour of the tree.
_TREES = """WITH RECURSIVE e AS (SELECT revision_id AS id, max(nullif(parent_revision_id, 0)) AS p FROM revisions WHERE revision_id <> 0 GROUP BY 1),
  t AS (SELECT id, id AS root, CAST(0 AS BIGINT) AS depth FROM e WHERE p IS NULL OR p NOT IN (SELECT id FROM e) UNION ALL SELECT e.id, t.root, t.depth + 1 FROM e JOIN t ON e.p = t.id),
  loose AS (SELECT * FROM e WHERE id NOT IN (SELECT id FROM t)),
  reach AS (SELECT id, p AS anc FROM loose UNION SELECT r.id, l.p FROM reach r JOIN loose l ON r.anc = l.id),
  ring AS (SELECT id FROM reach WHERE id = anc),
  f AS (SELECT id AS revision_id, root AS root_revision_id, depth FROM t UNION ALL SELECT id, min(anc), -1 FROM reach WHERE anc IN (SELECT id FROM ring) GROUP BY id)"""
_WAYS = (
    _TREES
    + """, c AS (SELECT e.id, p, root_revision_id AS root, depth FROM e JOIN f ON e.id = f.revision_id),
  w AS (SELECT id, root, depth, [id] AS way FROM c WHERE id = root UNION ALL SELECT c.id, c.root, c.depth, list_append(w.way, c.id) FROM c JOIN w ON c.p = w.id WHERE c.id <> c.root),
  below AS (SELECT anc, count(*) - 1 AS n FROM (SELECT unnest(way) AS anc FROM w) GROUP BY 1)"""
)


@query("p2_found", f"{_TREES} SELECT * FROM f")
def p2_found(spark, d):
    h = tree.hierarchy(table(spark, d, "revisions"), "revision_id", "parent_revision_id", "page_id")
    return h.select(F.col("id").alias("revision_id"), F.col("root").alias("root_revision_id"), "depth")


@query(
    "p2_intervals",
    _WAYS
    + """ SELECT id AS revision_id, root AS root_revision_id, depth, "entry", "entry" + 2 * n + 1 AS "exit", n AS n_descendants
  FROM (SELECT *, 2 * (row_number() OVER (PARTITION BY root ORDER BY way) - 1) - (len(way) - 1) AS "entry" FROM w JOIN below ON anc = id)""",
)
def p2_intervals(spark, d):
    iv = tree.intervals(table(spark, d, "revisions"), "revision_id", "parent_revision_id", "page_id")
    return iv.select(F.col("id").alias("revision_id"), F.col("root").alias("root_revision_id"), "depth", "entry", "exit", "n_descendants")


def _histories(spark, d):
    return tree.histories(table(spark, d, "revisions"), "revision_id", "parent_revision_id", "page_id")


@query("p2_histories", _WAYS + " SELECT id AS revision_id, root AS root_revision_id, depth, array_to_string(way, '/') AS path, n AS n_later FROM w JOIN below ON anc = id")
def p2_histories(spark, d):
    """Path, depth, first revision and number of later revisions of every revision; see ``hierarchy.intervals`` for those on or below cycles.

    ``p2_descendants`` lists the later revisions.
    """
    h = _histories(spark, d)
    return h.groupBy(F.col("id").alias("revision_id"), F.col("root").alias("root_revision_id"), "depth").agg(
        F.max(F.array_join(F.transform("path", lambda x: x.cast("string")), "/")).alias("path"), F.sum(F.size("later")).cast("long").alias("n_later")
    )


@query("p2_descendants", _WAYS + " SELECT anc AS revision_id, id AS later_revision_id FROM (SELECT id, unnest(way) AS anc FROM w) WHERE anc <> id")
def p2_descendants(spark, d):
    """All later revisions of every revision, one row each."""
    return _histories(spark, d).select(F.col("id").alias("revision_id"), F.explode("later").alias("later_revision_id"))


_FIELDS = ("parent_revision_id", "page_id", "found_in_bundle")


_P3 = f"""WITH {_USABLE}, r AS (SELECT revision_id, i, unnest(['parent_revision_id', 'page_id', 'found_in_bundle']) AS ref_field,
    unnest([parent_revision_id, page_id, found_in_bundle]) AS ref_id FROM u),
  live AS (SELECT 'parent_revision_id' AS f, revision_id AS k FROM u WHERE revision_id NOT IN (SELECT ref_id FROM tombstones WHERE ref_table = 'revisions' AND restored_at IS NULL)
    UNION SELECT 'page_id', numeric_page_id FROM web_resources WHERE numeric_page_id IS NOT NULL AND numeric_page_id NOT IN (SELECT ref_id FROM tombstones WHERE ref_table = 'web_resources' AND restored_at IS NULL)
    UNION SELECT 'found_in_bundle', id FROM revision_bundles WHERE id NOT IN (SELECT ref_id FROM tombstones WHERE ref_table = 'revision_bundles' AND restored_at IS NULL))
  SELECT DISTINCT ref_field, revision_id, ref_id, coalesce(strftime(i, '%Y-%m'), 'unknown') AS period FROM r WHERE ref_id <> 0
    AND NOT EXISTS (SELECT 1 FROM live WHERE f = ref_field AND k = ref_id)"""


@query("p3_found", _P3)
def p3_found(spark, d):
    day = F.date_from_unix_date(F.floor(instant(F.col("revision_timestamp")) / 86400).cast("int"))
    month = F.coalesce((F.year(day) * 12 + F.month(day) - 1).cast("int"), F.lit(-1))
    rows = log(spark, d, "revision_id", *_FIELDS, month.alias("period"))
    key = lambda df, f, c: df.select(F.lit(f).alias("field"), F.col(c).alias("key")).filter("key IS NOT NULL")
    parents = key(log(spark, d, "revision_id"), _FIELDS[0], "revision_id").unionByName(key(table(spark, d, "web_resources"), _FIELDS[1], "numeric_page_id"))
    parents = parents.unionByName(key(table(spark, d, "revision_bundles"), _FIELDS[2], "id"))
    field = F.when(F.col("ref_table") == "revisions", _FIELDS[0]).when(F.col("ref_table") == "web_resources", _FIELDS[1]).when(F.col("ref_table") == "revision_bundles", _FIELDS[2])
    deleted = table(spark, d, "tombstones").filter("restored_at IS NULL").select(field.alias("field"), F.col("ref_id").alias("key")).dropna()
    out = orphan_references(rows, list(_FIELDS), parents, deleted, ["revision_id"])
    period = F.when(F.col("period") < 0, "unknown").otherwise(F.format_string("%04d-%02d", F.floor(F.col("period") / 12), F.pmod(F.col("period"), F.lit(12)) + 1))
    return out.select("ref_field", "revision_id", "ref_id", period.alias("period"))


#: The log's batches reach the index in so many turns, one after another; runs are merged on the way.
P4_TURNS = 5


@query("p4_found", f"WITH {_USABLE} SELECT delivery_id FROM (SELECT delivery_id, row_number() OVER (PARTITION BY revision_id, i ORDER BY delivery_id) AS k FROM u WHERE i IS NOT NULL) WHERE k > 1")
def p4_found(spark, d):
    at = instant(F.col("revision_timestamp"))
    rows = log(spark, d, "delivery_id", "revision_id", "batch_id", at.alias("instant")).filter("instant IS NOT NULL")
    lo, hi = table(spark, d, "revisions").agg(F.min("batch_id"), F.max("batch_id")).first()
    if lo is None:
        return rows.select("delivery_id")
    step = (hi - lo) // P4_TURNS + 1
    turn = F.floor((F.col("batch_id") - lo) / step)
    sizes = {r[0]: r[1] for r in log(spark, d, "batch_id").groupBy(turn.alias("turn")).count().collect()}  # a row a turn
    index, kept = DedupIndex(spark, scratch(spark, "dedup")), None
    for k in sorted(sizes):
        batch = rows.filter(F.col("batch_id").between(lo + k * step, lo + (k + 1) * step - 1))
        out = index.ingest(batch, "revision_id", "instant", "delivery_id", sizes[k])
        kept = out if kept is None else kept.unionByName(out)
    return rows.select("delivery_id").limit(0) if kept is None else repeats(rows, kept, "delivery_id")


@query("p6_found", "SELECT page_id FROM revisions WHERE page_id <> 0 GROUP BY page_id HAVING count(*) >= 0.01 * (SELECT count(*) FROM revisions)")
def p6_found(spark, d):
    return skew.heavy_keys(table(spark, d, "revisions"), "page_id", "delivery_id", 0.01).select("page_id")


@query(
    "p6_page_profile",
    """SELECT page_id, count(*) AS n_rows, min(delivery_id) AS first_delivery, max(delivery_id) AS last_delivery, CAST(sum(coalesce(length, 0)) AS BIGINT) AS total_length,
  coalesce(max(step), 0) AS max_step FROM (SELECT *, delivery_id - lag(delivery_id) OVER (PARTITION BY page_id ORDER BY delivery_id) AS step FROM revisions) GROUP BY page_id""",
)
def p6_page_profile(spark, d):
    """Results of every page, heavy or not: rows, deliveries, bytes and the longest pause between two deliveries."""
    out = skew.group_profile(table(spark, d, "revisions"), "page_id", "delivery_id", "length")
    return out.select("page_id", "n_rows", F.col("first_order").alias("first_delivery"), F.col("last_order").alias("last_delivery"), F.col("total").alias("total_length"), "max_step")


@query("p3_orphans_per_period", f"SELECT ref_field, period, count(*) AS n_references, count(DISTINCT ref_id) AS n_keys FROM ({_P3}) GROUP BY 1, 2")
def p3_orphans_per_period(spark, d):
    """Orphan references counted per field and month."""
    found, _ = stage(p3_found(spark, d), "found")
    return found.groupBy("ref_field", "period").agg(F.count("*").alias("n_references"), F.countDistinct("ref_id").alias("n_keys"))
