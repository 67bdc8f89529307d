"""Pages and revisions out of parsed dump rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import output_name, parse_id, parse_ns


def in_names(namespaces: list[str], column: str = "ns"):
    return F.col(column).isin([str(x) for x in namespaces])


def in_namespaces(pages: DataFrame, namespaces: list[str] | None, column: str = "ns") -> DataFrame:
    """Exact string membership of the raw namespace, applied to pages, before revisions are exploded; None keeps all."""
    return pages if namespaces is None else pages.filter(in_names(namespaces, column))


#: ``pos`` of a row that stands for a page without revisions, and of one that reports damaged input.
NO_REVISION, DAMAGED = -1, -2
#: What every row of a shredded dump has.
ROW = ["file", "page_seq", "pos", "page_raw", "ns_raw", "title", "rev_raw", "parent_raw", "timestamp", "user_raw", "text"]


def is_damaged():
    """Is a row of ``read_pages`` what is left of a page that can't be parsed?"""
    return F.coalesce("title", "ns", "id").isNull() & F.col("revision").isNull()


def rows_of(pages: DataFrame) -> DataFrame:
    """One row per revision in document order (``page_seq``, ``pos``), one for each page without any (``pos`` -1), one for each page that can't be parsed (-2).

    So one scan gives pages, revisions and damages. Missing contributor: user '0'. Missing text or timestamp: ''.
    """
    e = F.lit("")
    damaged = is_damaged()
    raw = pages.withColumn("page_seq", F.monotonically_increasing_id()).select(
        "file", "page_seq", F.coalesce("id", e).alias("page_raw"), F.coalesce("ns", e).alias("ns_raw"), F.coalesce("title", e).alias("title"), damaged.alias("damaged"),
        F.posexplode_outer("revision").alias("pos", "r"),
    )
    bad = F.col("damaged")
    return raw.select(
        "file", "page_seq", F.when(bad, F.lit(DAMAGED)).otherwise(F.coalesce("pos", F.lit(NO_REVISION))).alias("pos"), "page_raw", "ns_raw", "title",
        F.coalesce("r.id", e).alias("rev_raw"), F.coalesce("r.parentid", e).alias("parent_raw"), F.coalesce("r.timestamp", e).alias("timestamp"),
        F.coalesce("r.contributor.id", F.lit("0")).alias("user_raw"), F.when(bad, F.lit("page could not be parsed")).otherwise(F.coalesce("r.text._VALUE", e)).alias("text"),
    )


def typed(rows: DataFrame) -> DataFrame:
    """Parsed ids beside the raw header fields, the archive's name, and the ``message`` of a damage. Unparseable ids: 0, parent: NULL."""
    c = F.col
    return rows.select(
        *ROW, parse_id(c("rev_raw")).alias("rev_id"), parse_id(c("parent_raw"), None).alias("parent_rev_id"), parse_id(c("page_raw")).alias("page_id"),
        parse_ns(c("ns_raw")).alias("ns"), output_name(c("file")).alias("file_path"), F.when(c("pos") == DAMAGED, c("text")).alias("message"),
    )


def pages_of(rows: DataFrame) -> DataFrame:
    """One row per page with a non-empty id and title, from the page's first row: no de-duplication of revisions is needed."""
    first = rows.filter(F.col("pos").isin(0, NO_REVISION) & (F.col("page_raw") != "") & (F.col("title") != ""))
    return first.select(parse_id(F.col("page_raw")).alias("page_id"), parse_ns(F.col("ns_raw")).alias("ns"), "title", "file")


def revisions_of(rows: DataFrame) -> DataFrame:
    return typed(rows.filter("pos >= 0"))


def damages_of(rows: DataFrame) -> DataFrame:
    """(file, page_seq, message) of input that could not be read."""
    return rows.filter(F.col("pos") == DAMAGED).select("file", "page_seq", "message")
