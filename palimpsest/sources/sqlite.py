"""The index as one SQLite file: a partitioned reader and a staged, set-based writer.

The writer is for the sizes SQLite is for: the format allows one writer, so rows
stream through it, a batch at a time. Larger indexes stay in ``IndexStore``.
The merge statements are plain SQL with ON CONFLICT, which PostgreSQL takes as well (``sources/postgres.py``).
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType

from palimpsest import schema

BATCH = 10_000
#: Columns that identify a row, and what happens to a row that is there already.
KEYS = {"domains": ("value", "ignore"), "documents": ("title", "ignore"), "revision_bundles": ("file_path", "ignore"), "revisions": ("revision_id", "ignore"), "web_resources": ("url_hash", "update")}


def ddl(table: str) -> str:
    cols = []
    for f in schema.INDEX[table].fields:
        kind = "INTEGER" if isinstance(f.dataType, LongType) else "TEXT"
        cols.append(f"{f.name} {kind}" + (" PRIMARY KEY" if f.name in ("id", "revision_id") else " UNIQUE" if KEYS.get(table, ("",))[0] == f.name else ""))
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(cols)})"


def merge_sql(table: str, staging: str) -> str:
    """Insert staged rows; on a key that exists keep the old row or take over the new values, never a NULL document link."""
    names = schema.INDEX[table].fieldNames()
    key, rule = KEYS[table]
    update = ", ".join(f"{c} = coalesce(excluded.{c}, {table}.{c})" if c == "instance_of_document" else f"{c} = excluded.{c}" for c in names if c not in ("id", key))
    return f"INSERT INTO {table} ({', '.join(names)}) SELECT {', '.join(names)} FROM {staging} WHERE true ON CONFLICT ({key}) DO " + ("NOTHING" if rule == "ignore" else f"UPDATE SET {update}")


def write_sqlite(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Merge tables into the file, each through a staging table and one statement, all in one transaction; returns staged rows."""
    db, counts = sqlite3.connect(path, isolation_level=None), {}
    try:
        db.execute("PRAGMA journal_mode=WAL")
        db.execute("PRAGMA synchronous=NORMAL")
        db.execute("BEGIN IMMEDIATE")
        for name in ("containers", *KEYS):
            db.execute(ddl(name))
        for name, df in tables.items():
            names = schema.INDEX[name].fieldNames()
            db.execute(f"CREATE TEMP TABLE staged_{name} ({', '.join(names)})")
            counts[name], batch = 0, []
            insert = f"INSERT INTO staged_{name} VALUES ({', '.join('?' * len(names))})"
            for row in df.select(*names).toLocalIterator(prefetchPartitions=True):
                batch.append(tuple(row))
                if len(batch) == BATCH:
                    db.executemany(insert, batch)
                    counts[name], batch = counts[name] + BATCH, []
            db.executemany(insert, batch)
            counts[name] += len(batch)
            db.execute(merge_sql(name, f"staged_{name}"))
            db.execute(f"DROP TABLE staged_{name}")
        db.execute("COMMIT")
    except BaseException:
        if db.in_transaction:
            db.execute("ROLLBACK")
        raise
    finally:
        db.close()
    return counts


class _Range(InputPartition):
    def __init__(self, lo: int, hi: int):
        self.lo, self.hi = lo, hi


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.table, self.parts = options["path"], options["dbtable"], int(options.get("numpartitions", 8))

    def _open(self):
        return sqlite3.connect(f"file:{self.path}?mode=ro", uri=True)  # a missing file is an error, not an empty index

    def partitions(self):
        with self._open() as db:
            lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {self.table}").fetchone()
        if lo is None:
            return [_Range(0, 0)]
        step = (hi - lo) // self.parts + 1
        return [_Range(a, min(a + step, hi + 1)) for a in range(lo, hi + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        names = ", ".join(schema.INDEX[self.table].fieldNames())
        with self._open() as db:
            yield from db.execute(f"SELECT {names} FROM {self.table} WHERE rowid >= ? AND rowid < ?", (partition.lo, partition.hi))


class SqliteSource(DataSource):
    """``spark.read.format("sqlite_index").option("dbtable", name).load(path)``, split by rowid."""

    @classmethod
    def name(cls):
        return "sqlite_index"

    def schema(self):
        return schema.INDEX[self.options["dbtable"]]

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_sqlite(spark: SparkSession, path: str, table: str) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_index").option("dbtable", table).load(path)
