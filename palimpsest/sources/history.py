"""Full-history dumps whose pages are too large for one row: revisions streamed one at a time.

The row-tag reader holds a page with all its revisions in memory. This source parses with a
pull parser and gives every revision as it ends, so a task holds one revision, however long its page.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from palimpsest.operators.shred import DAMAGED, NO_REVISION
from palimpsest.sources.dump import opened

SCHEMA = "file string, page_seq long, pos int, page_raw string, ns_raw string, title string, rev_raw string, parent_raw string, timestamp string, user_raw string, text string"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def events(path: str, namespaces: frozenset | None, preserve: bool) -> Iterator[tuple]:
    """Rows of one file: a page without revisions gives one row whose ``pos`` is -1. Damage gives the rows before it and one whose ``pos`` is -2 that tells the place."""
    name, seq = os.path.basename(path), -1
    page, rev, depth, pos, kept, root, holder = {}, {}, [], 0, True, None, None
    clean = (lambda s: s or "") if preserve else (lambda s: (s or "").strip(" \t\r\n"))
    with opened(path) as f:
        parser = ElementTree.iterparse(f, ("start", "end"))
        try:
            for event, e in parser:
                tag = _local(e.tag)
                if event == "start":
                    root = e if root is None else root
                    depth.append(tag)
                    if tag == "page":
                        page, pos, seq, holder = {}, 0, seq + 1, e
                    elif tag == "revision":
                        rev = {}
                        kept = namespaces is None or page.get("ns", "") in namespaces
                    continue
                depth.pop()
                up = depth[-1] if depth else ""
                if up == "contributor" and tag == "id":
                    rev["user"] = clean(e.text)
                elif up == "revision" and tag in ("id", "parentid", "timestamp", "text"):
                    rev[tag] = clean(e.text) if tag == "text" else (e.text or "").strip()
                elif up == "page" and tag in ("id", "ns", "title"):
                    page[tag] = (e.text or "").strip()
                elif tag == "revision":
                    if kept:
                        yield (name, seq, pos, page.get("id", ""), page.get("ns", ""), page.get("title", ""), rev.get("id", ""), rev.get("parentid", ""), rev.get("timestamp", ""), rev.get("user") or "0", rev.get("text", ""))
                        pos += 1
                elif tag == "page" and not pos and (namespaces is None or page.get("ns", "") in namespaces):
                    yield (name, seq, NO_REVISION, page.get("id", ""), page.get("ns", ""), page.get("title", ""), "", "", "", "0", "")
                if tag in ("revision", "page"):
                    e.clear()
                    if tag == "revision" and holder is not None and e in holder:
                        holder.remove(e)
                    if tag == "page" and root is not None:
                        root.clear()  # else the emptied pages stay
        except (ElementTree.ParseError, EOFError, OSError) as e:
            yield (name, seq + 1, DAMAGED, "", "", "", "", "", "", "0", f"{type(e).__name__}: {e}")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["paths"].split("\n") if p]
        ns = options.get("namespaces")
        self.namespaces = None if ns is None else frozenset(x for x in ns.split(",") if x)
        self.preserve = options.get("preservetext", "false") == "true"

    def partitions(self):
        return [_File(p) for p in self.paths] or [_File("")]

    def read(self, partition):
        if partition.path:
            yield from events(partition.path, self.namespaces, self.preserve)


class HistorySource(DataSource):
    """``spark.read.format("wikihistory").option("paths", newline-separated)``: one task per file."""

    @classmethod
    def name(cls):
        return "wikihistory"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_history(spark: SparkSession, paths: list[str], namespaces: list[str] | None = None, preserve_text: bool = False) -> DataFrame:
    """Rows of all files; the namespace filter is applied in the parser, before a text leaves it."""
    spark.dataSource.register(HistorySource)
    r = spark.read.format("wikihistory").option("paths", "\n".join(paths)).option("preservetext", str(preserve_text).lower())
    return (r if namespaces is None else r.option("namespaces", ",".join(namespaces))).load()
