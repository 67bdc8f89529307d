"""The index in PostgreSQL: partitioned reads, staged writes, and merges in one transaction that is tried again on conflicts.

Rows travel by Spark's JDBC source from all executors, to and from tables named ``staged_...``; the merge itself is a few set-based statements on one
connection. ``connect`` is any function that gives a DB-API connection, so no driver is named here; none is installed in the tests, which pass a stand-in.
"""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palimpsest import schema
from palimpsest.operators.index import TRIES, missing_tables
from palimpsest.sources.sqlite import KEYS, merge_sql

LOG = logging.getLogger(__name__)
#: Waiting time of the first retry, and the states of a serialisation failure and of a deadlock.
BACKOFF_SECONDS, CONFLICTS = 0.1, ("40001", "40P01")
REQUIRED = ("containers", "documents", "web_resources", "domains", "revision_bundles", "revisions")
#: Parts that a table is read in.
PARTS = 64


def settings(env=None) -> dict[str, str] | None:
    """Connection settings of the environment: ``DATABASE=postgres`` and ``DB_HOST``, ``DB_PORT``, ``DB_NAME``, ``DB_USER``, ``DB_PASS``; None without the first.

    A missing one of the others is an error.
    """
    env = os.environ if env is None else env
    if env.get("DATABASE") != "postgres":
        return None
    names = {"host": "DB_HOST", "port": "DB_PORT", "name": "DB_NAME", "user": "DB_USER", "password": "DB_PASS"}
    if lacking := [v for v in names.values() if not env.get(v)]:
        raise ValueError(f"set {', '.join(lacking)}")
    return {k: env[v] for k, v in names.items()}


def jdbc(s: dict[str, str]) -> tuple[str, dict[str, str]]:
    """(url, properties) for Spark's JDBC source."""
    return f"jdbc:postgresql://{s['host']}:{s['port']}/{s['name']}", {"user": s["user"], "password": s["password"], "driver": "org.postgresql.Driver", "reWriteBatchedInserts": "true"}


def connector(s: dict[str, str]) -> Callable:
    """A function that connects by whichever Python driver is installed."""

    def connect():
        try:
            import psycopg as driver
        except ImportError:
            import psycopg2 as driver
        return driver.connect(host=s["host"], port=s["port"], dbname=s["name"], user=s["user"], password=s["password"])

    return connect


def check_tables(connect: Callable) -> None:
    """Raise unless every table of the index is there."""
    db = connect()
    try:
        cursor = db.cursor()
        cursor.execute("SELECT table_name FROM information_schema.tables WHERE table_schema = 'public'")
        there = {r[0] for r in cursor.fetchall()}
    finally:
        db.close()
    if lacking := missing_tables(list(REQUIRED), there.__contains__):
        raise RuntimeError(f"tables are missing: {', '.join(lacking)}")


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str], bounds: tuple[int, int] | None = None, parts: int = PARTS) -> DataFrame:
    """A table of the index. With ``bounds`` of its id it is read in ``parts`` ranges at once; rows beyond the bounds are in the outer ranges."""
    kind = schema.INDEX[table]
    key = "revision_id" if table == "revisions" else "id"
    read = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties).option("fetchsize", 10_000)
    if bounds:
        read = read.option("partitionColumn", key).option("lowerBound", bounds[0]).option("upperBound", bounds[1] + 1).option("numPartitions", parts)
    return read.load().select(*kind.fieldNames())


def known_ids(connect: Callable, ids: list[int]) -> set[int]:
    """Those of the revisions that are indexed with a bundle; for the ids of one micro-batch, 500 a question."""
    db, found = connect(), set()
    try:
        cursor = db.cursor()
        for i in range(0, len(ids), 500):
            part = ",".join(str(int(x)) for x in ids[i : i + 500])
            cursor.execute(f"SELECT revision_id FROM revisions WHERE found_in_bundle IS NOT NULL AND revision_id IN ({part})")
            found |= {r[0] for r in cursor.fetchall()}
    finally:
        db.close()
    return found


def latest(connect: Callable) -> str | None:
    """The greatest timestamp of the index, as written."""
    db = connect()
    try:
        cursor = db.cursor()
        cursor.execute("SELECT max(revision_timestamp) FROM revisions")
        return cursor.fetchone()[0]
    finally:
        db.close()


def stage_by_jdbc(url: str, properties: dict[str, str]) -> Callable[[DataFrame, str], None]:
    """Writes a table in parallel, as a new one."""
    return lambda df, name: df.write.mode("overwrite").option("batchsize", 10_000).jdbc(url, name, properties=properties)


def _state(e: Exception) -> str | None:
    return getattr(e, "sqlstate", None) or getattr(e, "pgcode", None)


#: Columns that refer to another table, the table, and the column by which its rows are known on both sides.
_LINKS = {"web_resources": {"domain_id": ("domains", "value"), "instance_of_document": ("documents", "title")}, "revisions": {"found_in_bundle": ("revision_bundles", "file_path")}}


def server_merge_sql(table: str) -> str:
    """Merge staged rows under the server's own ids: it numbers new rows, and references are carried over by what their rows are known by.

    A title that stands there several times counts as its first row.
    """
    names = [c for c in schema.INDEX[table].fieldNames() if c != "id"]
    links = _LINKS.get(table, {})
    joins = "".join(
        f" LEFT JOIN staged_{t} s_{c} ON s_{c}.id = w.{c} LEFT JOIN (SELECT {k}, min(id) AS id FROM {t} GROUP BY {k}) t_{c} ON t_{c}.{k} = s_{c}.{k}" for c, (t, k) in links.items()
    )
    chosen = ", ".join(f"t_{c}.id" if c in links else f"w.{c}" for c in names)
    conflict = merge_sql(table, "").partition(" ON CONFLICT ")[2]
    return f"INSERT INTO {table} ({', '.join(names)}) SELECT {chosen} FROM staged_{table} w{joins} WHERE true ON CONFLICT {conflict}"


def merge_tables(tables: dict[str, DataFrame], connect: Callable, stage: Callable[[DataFrame, str], None]) -> int:
    """Merge the index's tables into the server's: each is staged, then all are merged in one transaction. Returns how many tries that took.

    Tables that others refer to must come along (``domains`` and ``documents`` with ``web_resources``, ``revision_bundles`` with ``revisions``).

    A serialisation failure or deadlock rolls back and is tried again after 100 ms times the number of the try, ``TRIES`` times at most; another error is
    raised at once. Either all tables are merged or none.
    """
    for name, df in tables.items():
        stage(df.select(*schema.INDEX[name].fieldNames()), f"staged_{name}")
    for turn in range(1, TRIES + 1):
        db = connect()
        try:
            cursor = db.cursor()
            for name in (n for n in KEYS if n in tables):
                cursor.execute(server_merge_sql(name))
            for name in tables:
                cursor.execute(f"DROP TABLE staged_{name}")
            db.commit()
            return turn
        except Exception as e:
            db.rollback()
            if turn == TRIES or _state(e) not in CONFLICTS:
                raise
            LOG.warning("merge: %s, trying again", e)
            time.sleep(BACKOFF_SECONDS * turn)
        finally:
            db.close()
    return TRIES


__all__ = ["check_tables", "connector", "jdbc", "known_ids", "latest", "merge_tables", "read_table", "server_merge_sql", "settings", "stage_by_jdbc"]
