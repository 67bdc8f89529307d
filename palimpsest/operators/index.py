"""Relational index as Parquet tables: merges by key and a store with atomic versions."""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest import schema
from palimpsest.functions import page_url, url_hash
from palimpsest.session import Superseded, publish, published, stage


def _pick(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the one that ``order`` puts first. An aggregate, so copies of a hot key meet map-side."""
    cols = [c for c in df.columns if c not in keys]
    first = F.struct(*order, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    best = df.groupBy(*keys).agg(F.min(first).alias("_best"))
    return best.select(*[k if k in keys else F.col(f"_best._v{cols.index(k)}").alias(k) for k in df.columns])


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep per key the row lowest in ``order`` (NULL sorts first; full ties: the lowest row)."""
    return _pick(df, keys, [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep per key the row highest in ``order``."""
    cols = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])).alias("_best"))
    return best.select(*[k if k in keys else F.col(f"_best._v{cols.index(k)}").alias(k) for k in df.columns])


def fresh_rows(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first new row of each key that ``existing`` lacks. Rows without a key are not inserted."""
    fresh = first_wins(new.filter(F.col(key).isNotNull()), [key], order).join(existing.select(key), key, "left_anti")
    return fresh.select(*existing.columns)


def insert_ignore(existing: DataFrame, new: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``existing`` plus ``fresh_rows``."""
    return existing.unionByName(fresh_rows(existing, new, key, order))


def upsert(existing: DataFrame, new: DataFrame, key: str, order: list[str], keep: list[str] = ()) -> DataFrame:
    """Last new row of a key replaces the existing one; columns in ``keep`` hold their old value where it exists."""
    fresh = last_wins(new.filter(F.col(key).isNotNull()), [key], order)
    e, n = existing.alias("e"), fresh.alias("n")
    took = F.col(f"n.{key}").isNotNull()
    cols = []
    for c in existing.columns:
        old, now = F.col(f"e.{c}"), F.col(f"n.{c}") if c in fresh.columns else F.lit(None)
        cols.append((F.coalesce(old, now) if c in keep or c == key or c not in fresh.columns else F.when(took, now).otherwise(old)).alias(c))
    return e.join(n, F.col(f"e.{key}") == F.col(f"n.{key}"), "full_outer").select(*cols)


def next_ids(keys: DataFrame, key: str, start: Column | int = 0, parts: int | None = None) -> DataFrame:
    """Dense ids by key order without a single-task window: range partitions are numbered, then shifted by the counts before them."""
    from palimpsest.operators.skew import running_sum

    out = running_sum(keys.select(key).distinct().withColumn("_one", F.lit(1).cast("long")), [], [key], "_one", "_n", parts)
    return out.select(key, (F.col("_n") + start).cast("long").alias("id"))


#: So many new keys, those of a micro-batch say, are numbered by one task; more by range partitions.
ONE_TASK_KEYS = 100_000


def dimension_rows(existing: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Rows for the values of ``key`` that ``existing`` lacks, with the ids that follow; other columns are NULL."""
    new, _ = stage(values.select(key).filter(F.col(key).isNotNull()).distinct().join(existing.select(key), key, "left_anti"), "new")
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top")).scalar()
    few = new.count() <= ONE_TASK_KEYS
    numbered = new.select(key, F.row_number().over(Window.orderBy(key)).cast("long").alias("id")) if few else next_ids(new, key)
    rows = numbered.withColumn("id", F.col("id") + top)
    return rows.select(*[F.col(f.name) if f.name in (key, "id") else F.lit(None).cast(f.dataType).alias(f.name) for f in existing.schema.fields])


def grow_dimension(existing: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Get-or-create: existing rows plus ``dimension_rows``."""
    return existing.unionByName(dimension_rows(existing, values, key))


def documents_by_title(documents: DataFrame) -> DataFrame:
    """(title, document_id): the smallest id of each title."""
    return documents.filter("title IS NOT NULL").groupBy("title").agg(F.min("id").alias("document_id"))


def backfill_documents(resources: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Fill NULL ``instance_of_document`` by the page's last title, matched on (domain, page)."""
    titles = last_wins(pages.select("domain_id", "page_id", "title", "seq"), ["domain_id", "page_id"], ["seq"])
    ids = titles.join(documents_by_title(documents), "title").select(F.col("domain_id"), F.col("page_id").alias("numeric_page_id"), "document_id")
    out = resources.join(ids, ["domain_id", "numeric_page_id"], "left")
    return out.withColumn("instance_of_document", F.coalesce("instance_of_document", "document_id")).select(*resources.columns)


def resources_of(pages: DataFrame) -> DataFrame:
    """web_resources rows of (page_id, ns, domain, domain_id, seq)."""
    url = page_url(F.col("domain"), F.col("page_id"))
    return pages.select(
        url.alias("url"), url_hash(url).alias("url_hash"), "domain_id", F.col("page_id").alias("numeric_page_id"), F.col("ns").cast("long").alias("numeric_namespace_id"), "seq"
    )


def unseen(feed: DataFrame, index: DataFrame, key: str = "rev_id") -> DataFrame:
    """Feed rows whose revision has no archived copy in the index; NULL keys pass. Catalyst chooses the join by size."""
    done = index.filter("found_in_bundle IS NOT NULL").select(F.col("revision_id").alias(key)).distinct()
    return feed.join(done, key, "left_anti")


def missing_tables(names: list[str], there) -> list[str]:
    """Names for which ``there`` says no, in order: what has to be made before an index can be merged into."""
    return [n for n in names if not there(n)]


#: A table in more parts than this is rewritten as one.
MOST_PARTS = 16
#: Tables whose rows change, and what tells a row: their later parts hold what changed, and the last part with a key counts.
LATEST = {"web_resources": "url_hash"}
#: Fixed value: how often a merge is tried when other runs get ahead of it.
TRIES = 5


class IndexStore:
    """Versioned index: a table is a list of written parts; a commit writes parts and publishes the lists as one version.

    A run appends its new rows, and of tables whose rows change those that did; the rest is left alone. A failed commit leaves nothing
    visible. Of two runs at once the second starts over from the state of the first.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _pointer(self) -> dict:
        return json.loads(published(self.spark, self.root)[1] or "{}")

    def exists(self) -> bool:
        return bool(self._pointer())

    def _parts(self, name: str, parts: list[str]) -> DataFrame:
        kind = schema.INDEX[name]
        paths = [f"{self.root}/{x}" for x in parts]
        if not parts:
            return self.spark.createDataFrame([], kind)
        if name not in LATEST or len(parts) == 1:
            return self.spark.read.schema(kind).parquet(*paths)
        each = [self.spark.read.schema(kind).parquet(p).withColumn("_part", F.lit(i)) for i, p in enumerate(paths)]
        return last_wins(reduce(DataFrame.unionByName, each), [LATEST[name]], ["_part"]).drop("_part")

    def read(self, name: str) -> DataFrame:
        return self._parts(name, self._pointer().get(name, []))

    def state(self) -> dict:
        """What is published now, for ``since``."""
        return self._pointer()

    def since(self, before: dict) -> dict[str, DataFrame]:
        """Rows that were published after the state ``before``, with the rows of other tables that they refer to.

        A table that was rewritten since comes whole.
        """
        now = self._pointer()
        new = {t: self._parts(t, [p for p in now.get(t, []) if p not in before.get(t, [])]) for t in ("web_resources", "revisions", "documents", "revision_bundles")}
        named = lambda t, user, column: self.read(t).join(new[user].select(F.col(column).alias("id")).unionByName(new[t].select("id")).distinct(), "id", "left_semi")
        return {
            "domains": self.read("domains"), "documents": named("documents", "web_resources", "instance_of_document"), "web_resources": new["web_resources"],
            "revision_bundles": named("revision_bundles", "revisions", "found_in_bundle"), "revisions": new["revisions"],
        }

    def _write(self, name: str, df: DataFrame) -> str:
        at = f"{name}-{uuid.uuid4().hex}"
        df.select(*schema.INDEX[name].fieldNames()).write.parquet(f"{self.root}/{at}")
        return at

    def commit(self, after: int, pointer: dict, replaced: dict[str, str], appended: dict[str, str]) -> None:
        """Publish written parts on top of version ``after``, which was ``pointer``; tables of too many parts are rewritten on the way.

        Superseded parts stay for readers that are under way.
        """
        pointer = pointer | {name: [at] for name, at in replaced.items()}
        for name, at in appended.items():
            parts = [*pointer.get(name, []), at]
            pointer[name] = parts if len(parts) <= MOST_PARTS else [self._write(name, self._parts(name, parts))]
        publish(self.spark, self.root, after, json.dumps(pointer))

    def apply(self, pages: DataFrame, revisions: DataFrame, siteinfo: DataFrame) -> None:
        """Merge shredded pages (file, page_id, ns, title, seq) and revisions (file_path ... timestamp) of files with a domain.

        Pages of files without a domain wait in ``rejected_pages`` and are taken up by the run that brings their file's domain. Returns after the
        version is published; a run that others get ahead of is taken again, ``TRIES`` times at most.
        """
        for turn in range(1, TRIES + 1):
            try:
                return self._apply(pages, revisions, siteinfo)
            except Superseded:
                if turn == TRIES:
                    raise
                time.sleep(0.1 * turn)

    def _apply(self, pages: DataFrame, revisions: DataFrame, siteinfo: DataFrame) -> None:
        number, text = published(self.spark, self.root)
        pointer, added = json.loads(text or "{}"), {}
        old = lambda name: self._parts(name, pointer.get(name, []))

        def grown(name: str, rows: DataFrame) -> DataFrame:
            """The table with new rows, which are written first so that every later step sees the same ids."""
            added[name] = self._write(name, rows)
            return old(name).unionByName(self._parts(name, [added[name]]))

        sites = siteinfo.select("file", "domain").distinct()
        pages, _ = stage(pages.select("file", "page_id", F.col("ns").cast("long").alias("ns"), "title", "seq").unionByName(old("rejected_pages")), "pages")
        held = pages.join(sites, "file", "left_anti").distinct()
        domains = grown("domains", dimension_rows(old("domains"), sites.select(F.col("domain").alias("value")), "value"))
        known, _ = stage(pages.join(sites, "file").join(domains.select(F.col("value").alias("domain"), F.col("id").alias("domain_id")), "domain"), "known")
        documents = grown("documents", dimension_rows(old("documents"), pages.select("title"), "title"))
        added["web_resources"] = self._write("web_resources", changed_resources(old("web_resources"), known, documents))
        bundles = grown("revision_bundles", dimension_rows(old("revision_bundles"), revisions.select("file_path"), "file_path"))
        placed = revisions.join(bundles.withColumnRenamed("id", "found_in_bundle"), "file_path").select(
            F.col("rev_id").alias("revision_id"), "page_id", "found_in_bundle", "offset_begin", "length",
            F.col("parent_rev_id").alias("parent_revision_id"), F.col("timestamp").alias("revision_timestamp"),
        )
        grown("revisions", fresh_rows(old("revisions"), placed, "revision_id", ["found_in_bundle", "offset_begin"]))
        self.commit(number, pointer, {"rejected_pages": self._write("rejected_pages", held)}, added)


def changed_resources(old: DataFrame, pages: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of ``old`` resources that pages (domain, domain_id, page_id, ns, title, seq) change or add; rows that stay as they are are left out.

    Only resources of the pages' addresses, or of their (domain, page), can change, so no other row is shuffled with its columns.
    """
    rows, _ = stage(resources_of(pages), "resources")
    of = pages.select("domain_id", F.col("page_id").alias("numeric_page_id")).distinct()
    same = old.join(rows.select("url_hash").distinct(), "url_hash", "left_semi").select(*old.columns)
    touched, _ = stage(same.unionByName(old.join(of, ["domain_id", "numeric_page_id"], "left_semi").select(*old.columns)).dropDuplicates(["url_hash"]), "touched")
    ids = touched.select("id", "url_hash").unionByName(dimension_rows(old.select("id", "url_hash"), rows.select("url_hash"), "url_hash").select("id", "url_hash"))
    merged = upsert(touched.drop("id"), rows, "url_hash", ["seq"]).join(ids, "url_hash")
    now = backfill_documents(merged, pages, documents).select(*old.columns)
    return now.join(touched.select("url_hash", F.struct(*old.columns).alias("_was")), "url_hash", "left").filter(~F.col("_was").eqNullSafe(F.struct(*[now[c] for c in old.columns]))).select(*old.columns)


def number_rows(df: DataFrame, order: list[str]) -> DataFrame:
    """``rn`` from 1 in global ``order``, by range partitions."""
    from palimpsest.operators.skew import running_sum

    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), [], order, "_one", "rn").drop("_one")


__all__ = [
    "IndexStore", "backfill_documents", "changed_resources", "dimension_rows", "documents_by_title", "first_wins", "fresh_rows", "grow_dimension", "insert_ignore", "last_wins", "missing_tables",
    "next_ids", "number_rows", "resources_of", "unseen", "upsert",
]
