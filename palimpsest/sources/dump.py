"""Dump scans: MediaWiki XML, plain, bz2 or 7z, one file or a directory.

Row tags are parsed in the JVM; bz2 is decoded by Spark's own codec, all concatenated
streams included. Spark has no 7z codec, so such files are first unpacked into the shared folder, one task a file. What is not
needed as rows (the site's address) is read from the first kilobytes of a file.
"""

from __future__ import annotations

import bz2
import html
import os
import re
import shutil
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import schema
from palimpsest.functions import url_host
from palimpsest.sources.sevenzip import open_7z

SUFFIXES = (".bz2", ".7z", ".xml")


def list_dumps(path: str) -> list[str]:
    """A single file as it is; of a directory its dumps, not recursive, case-sensitive, sorted by path."""
    if os.path.isfile(path):
        return [path]
    return sorted(e.path for e in os.scandir(path) if e.is_file() and e.name.endswith(SUFFIXES))


def opened(path: str):
    """The XML of a dump file as a stream of bytes."""
    if path.endswith(".7z"):
        return open_7z(path)
    return bz2.open(path, "rb") if path.endswith(".bz2") else open(path, "rb")  # noqa: SIM115


def unpack_7z(spark: SparkSession, paths: list[str], out_dir: str) -> list[str]:
    """Unpack the first file of each archive into ``out_dir``, a task each; the other entries are ignored.

    Names stay, hence the names of what is made from them. A retried task begins its file anew.
    """

    def run(batches):
        import pandas as pd

        for pdf in batches:
            for path in pdf["path"]:
                os.makedirs(out_dir, exist_ok=True)
                out = os.path.join(out_dir, os.path.basename(path))
                part = f"{out}.{uuid.uuid4().hex}.part"
                with open_7z(path) as src, open(part, "wb") as to:
                    shutil.copyfileobj(src, to, 1 << 20)
                os.replace(part, out)
                yield pd.DataFrame({"path": [out]})

    if not paths:
        return []
    each = spark.createDataFrame([(p,) for p in paths], "path string").repartitionByRange(len(paths), "path")
    return sorted(r[0] for r in each.mapInPandas(run, "path string").collect())  # a name a file


def _rows(spark: SparkSession, paths: list[str], tag: str, struct, preserve_text: bool) -> DataFrame:
    reader = (
        spark.read.format("xml").schema(struct).option("rowTag", tag).option("mode", "PERMISSIVE")
        .option("ignoreSurroundingSpaces", str(not preserve_text).lower()).option("charset", "UTF-8")
    )
    return reader.load(paths).select("*", F.col("_metadata.file_name").alias("file"))


def read_pages(spark: SparkSession, paths: list[str], preserve_text: bool = False) -> DataFrame:
    """One row per ``<page>``: title, ns, id, revision array and ``file``; a page that can't be parsed is a row of NULLs and ends its file.

    An empty list of paths gives no rows. Surrounding blanks of text nodes are trimmed unless ``preserve_text``; a text of blanks alone is empty.
    """
    if not paths:
        return spark.createDataFrame([], schema.DUMP_PAGE).withColumn("file", F.lit("").cast("string"))
    return _rows(spark, paths, "page", schema.DUMP_PAGE, preserve_text)


def read_siteinfo(spark: SparkSession, paths: list[str], domain: str | None = None) -> DataFrame:
    """(file, domain, language_code) per file; ``domain`` overrides what the files say.

    Files whose base address is missing or unparseable have no row.
    """
    if not paths:
        return spark.createDataFrame([], "file string, domain string, language_code string")
    none = F.lit(None).cast("string").alias("language_code")
    if domain:
        return spark.createDataFrame([(os.path.basename(p),) for p in paths], "file string").select("file", F.lit(domain).alias("domain"), none)
    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({"file": [os.path.basename(p) for p in pdf["path"]], "base": [base_of(p) for p in pdf["path"]]})

    each = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 200))
    return each.mapInPandas(run, "file string, base string").select("file", url_host(F.col("base")).alias("domain"), none).filter("domain IS NOT NULL")


_BASE = re.compile(r"<base\b[^>]*>([^<]*)</base>")


def base_of(path: str) -> str | None:
    """Text of ``<base>`` in a dump's ``<siteinfo>``, which stands before the first page; nothing further is read or unpacked."""
    head = b""
    with opened(path) as f:
        while b"</siteinfo>" not in head and b"<page" not in head and (got := f.read(16_384)):
            head += got
    m = _BASE.search(head.partition(b"<page")[0].decode("utf-8", "replace"))
    return html.unescape(m.group(1)).strip() if m else None
