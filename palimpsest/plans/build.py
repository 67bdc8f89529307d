"""The build job: dumps in, archives, index and metadata out."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import byte_length
from palimpsest.operators.framing import frame, offsets_of_sizes
from palimpsest.operators.index import IndexStore
from palimpsest.operators.metadata import metadata, write_metadata
from palimpsest.operators.shred import damages_of, in_names, is_damaged, pages_of, rows_of, typed
from palimpsest.session import fs, remove, scratch, stage
from palimpsest.sources.dump import list_dumps, read_pages, read_siteinfo, unpack_7z
from palimpsest.sources.history import read_history
from palimpsest.sources.mwrev import archive_scan

LOG = logging.getLogger(__name__)
_KEEP = ["file", "file_path", "page_seq", "pos", "page_raw", "ns_raw", "title", "rev_id", "parent_rev_id", "page_id", "timestamp", "message"]


def shredded(spark: SparkSession, paths: list[str], namespaces: list[str] | None = None, preserve_text: bool = False, large_pages: bool = False) -> DataFrame:
    """Framed rows of dump files in file order by ``page_seq`` and ``pos``, those of pages without revisions and of damages (see ``shred.rows_of``) included.

    ``large_pages`` streams revisions for pages too large for a row.
    """
    if large_pages:
        return frame(typed(read_history(spark, paths, namespaces, preserve_text)))
    pages = read_pages(spark, paths, preserve_text)
    if namespaces is not None:
        pages = pages.filter(is_damaged() | in_names(namespaces))
    return frame(typed(rows_of(pages)))


def build(
    spark: SparkSession, source: str, out_dir: str | None = None, namespaces: list[str] | None = None, domain: str | None = None,
    index: str | None = None, parquet: str | None = None, preserve_text: bool = False, large_pages: bool = False,
) -> DataFrame:
    """Run the job; returns framed records in order. Without ``out_dir`` nothing is archived and file_path is 'stdout'.

    Dumps are parsed once: the pass that writes the archives gives the places of the revisions, the pages and what was damaged, as one staged table without texts.
    """
    paths = list_dumps(source)
    LOG.info("build: %d files of %s", len(paths), source)
    packed, work = [p for p in paths if p.endswith(".7z")], None
    if packed and not large_pages:
        work = scratch(spark, "7z")
        paths = [p for p in paths if p not in packed] + unpack_7z(spark, packed, fs(spark, work)[1].toUri().getPath())
    framed = shredded(spark, paths, namespaces, preserve_text, large_pages)
    path = None
    if out_dir:
        os.makedirs(out_dir, exist_ok=True)
        rows, path = stage(archive_scan(framed, out_dir, _KEEP), "places")
        revs = rows.filter("pos >= 0")
        _report(rows, out_dir)
    else:
        framed = framed.withColumn("file_path", F.lit("stdout"))
        if parquet or index:
            rows, path = stage(framed.select(*_KEEP, byte_length(F.col("header")).alias("_h"), byte_length(F.col("body")).alias("length")), "places")
            placed = offsets_of_sizes(rows.filter("pos >= 0").select("file", "page_seq", "pos", "_h", "length"), ["page_seq", "pos"], "file")
            revs = rows.filter("pos >= 0").drop("_h", "length").join(placed, ["file", "page_seq", "pos"])
    if parquet:
        write_metadata(metadata(pages_of(rows), revs), parquet)
    elif index:
        site = read_siteinfo(spark, paths, domain)
        IndexStore(spark, index).apply(pages_of(rows).withColumn("seq", F.monotonically_increasing_id()), revs, site)
    LOG.info("build: done, %s", out_dir or "stdout")
    if path:
        remove(spark, path)
    if out_dir:
        if work:
            remove(spark, work)
        return spark.createDataFrame([], "record string")
    return framed.filter("pos >= 0").orderBy("file", "page_seq", "pos").select(F.concat("header", "body").alias("record"))


def _report(rows: DataFrame, out_dir: str) -> None:
    """Counts of every file as log lines; damages also as a table beside the archives."""
    per = rows.groupBy("file").agg(F.count_if(F.col("pos").isin(0, -1)).alias("pages"), F.count_if(F.col("pos") >= 0).alias("revisions"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count_if(F.col("pos") == -2).alias("damages"))
    bad = 0
    for r in per.orderBy("file").toLocalIterator():  # a row a file
        LOG.info("build: %s: %d pages, %d revisions, %d bytes of text, %d damages", *r)
        bad += r["damages"]
    if bad:
        LOG.warning("build: %d places of the dumps could not be read, see %s/_damages", bad, out_dir)
        damages_of(rows).write.mode("append").parquet(os.path.join(out_dir, "_damages"))
