"""Archive records with their byte places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions import body, byte_length, header


def frame(revs: DataFrame, missing_parent: str = "") -> DataFrame:
    """Add ``header`` and ``body`` to shredded revisions; raw header fields are used as written."""
    c = F.col
    return revs.withColumn("header", header(c("page_raw"), c("ns_raw"), c("rev_raw"), c("parent_raw"), c("timestamp"), c("user_raw"), missing_parent)).withColumn(
        "body", body(c("text"))
    )


def with_offsets(framed: DataFrame, order: list[str], file: str = "file_path", parts: int | None = None) -> DataFrame:
    """Add ``offset_begin`` and ``length``: uncompressed bytes counted per file in ``order``.

    A file may hold most rows, so the running sum isn't taken in one task per
    file: rows are range-partitioned on (file, order), summed per partition,
    and the few partial sums (one per file and partition) are carried over.
    Texts do not travel: only their sizes are shuffled. A NULL file is a file of its own.
    """
    sized = framed.select(file, *order, byte_length(F.col("header")).alias("_h"), byte_length(F.col("body")).alias("length"))
    return offsets_of_sizes(sized, order, file, parts)


def offsets_of_sizes(sized: DataFrame, order: list[str], file: str = "file_path", parts: int | None = None) -> DataFrame:
    """Rows (file, order, _h, length) with ``offset_begin`` in place of ``_h``."""
    from palimpsest.operators.skew import running_sum

    size = F.col("_h") + F.col("length")
    out = running_sum(sized.withColumn("_size", size), [file], order, "_size", "_end", parts)
    return out.withColumn("offset_begin", (F.col("_end") - F.col("length")).cast("long")).drop("_h", "_size", "_end")
