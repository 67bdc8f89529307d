"""The ten-column metadata export."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest import schema
from palimpsest.functions import normalize_timestamp


def metadata(pages: DataFrame, revisions: DataFrame) -> DataFrame:
    """Pages and revisions as one sparse table; extra columns of the inputs are left out."""
    p = pages.select("page_id", F.col("ns").cast("long").alias("ns"), "title").withColumn("type", F.lit("page"))
    r = revisions.select("rev_id", "parent_rev_id", "page_id", "file_path", "offset_begin", "length", "timestamp").withColumn("type", F.lit("revision"))
    return p.unionByName(r, allowMissingColumns=True).select(*schema.METADATA.fieldNames())


def merge(parts: list[DataFrame]) -> DataFrame:
    """Concatenate exports; all rows are kept."""
    return reduce(lambda a, b: a.unionByName(b), [p.select(*schema.METADATA.fieldNames()) for p in parts])


def write_metadata(df: DataFrame, path: str, single_file: bool = False, append: bool = False) -> None:
    """Parquet export, written in parallel unless ``single_file``; appending keeps what earlier runs wrote."""
    (df.coalesce(1) if single_file else df).write.mode("append" if append else "overwrite").parquet(path)


def latest_timestamp(df: DataFrame, column: str = "timestamp", normalized: bool = True) -> DataFrame:
    """One row ``latest``: the greatest timestamp, NULL for none; only the one column is scanned."""
    c = F.col(column)
    return df.select(F.max(normalize_timestamp(c) if normalized else c).alias("latest"))
