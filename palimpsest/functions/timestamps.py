"""Timestamp spellings, read in UTC whatever the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["instant", "parse_timestamp", "normalize_timestamp", "date_prefix"]

_FORM = r"^\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}:\d{2}(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})| \d{2}:\d{2}:\d{2})$"


def instant(col: Column) -> Column:
    """Epoch second of a timestamp string, fraction dropped; NULL for null, other spellings and impossible dates or times.

    The form is checked first, then date, clock and zone are read by one cast that
    names its zone, so neither the session's zone nor ANSI mode matters. A leap second is no instant; offsets reach 18 hours.
    """
    zone = F.when(F.substring(col, 11, 1) == " ", F.lit("Z")).when(col.endswith("Z"), F.lit("Z")).otherwise(F.right(col, F.lit(6)))
    whole = F.concat(F.substring(col, 1, 10), F.lit(" "), F.substring(col, 12, 8), zone)
    return F.unix_seconds(F.when(col.rlike(_FORM), whole).try_cast("timestamp"))


def parse_timestamp(col: Column) -> Column:
    """The string as a timestamp; NULL where it has none."""
    return F.timestamp_seconds(instant(col))


def normalize_timestamp(col: Column) -> Column:
    """``YYYY-MM-DDThh:mm:ssZ``; sub-seconds dropped, NULL where unparseable."""
    wall = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(secs=instant(col).cast("decimal(18,6)"))
    return F.concat(F.translate(wall.cast("string"), " ", "T"), F.lit("Z"))


def date_prefix(col: Column) -> Column:
    """The first ten characters; NULL for a shorter string."""
    return F.when(F.length(col) >= 10, F.substring(col, 1, 10))
