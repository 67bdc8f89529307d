"""Scalar functions of the pipeline as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "url_hash", "copy_escape", "url_host", "page_url", "body", "header", "output_name", "daily_path",
    "parse_id", "parse_ns", "byte_length", "joined_ids",
]


def url_hash(url: Column) -> Column:
    """Lower-case hexadecimal MD5."""
    return F.md5(url.cast("binary"))


def copy_escape(text: Column) -> Column:
    """Escape backslash, tab, newline and carriage return for a text bulk load; NUL is dropped."""
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, esc in (("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"), ("\0", "")):
        out = F.replace(out, F.lit(raw), F.lit(esc))
    return out


def url_host(url: Column) -> Column:
    """Lower-case host of a URL; NULL if there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def page_url(domain: Column, page_id: Column) -> Column:
    return F.concat(F.lit("https://"), domain, F.lit("/w/index.php?curid="), page_id.cast("string"))


def body(text: Column) -> Column:
    """Archive body: each line led by one blank and ended by a newline; an empty or NULL text has an empty body.

    Lines end at LF or CRLF, a final line end opens no further line, a lone CR stays.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.regexp_replace(F.replace(t, F.lit("\r\n"), F.lit("\n")), r"\n\z", "")
    return F.when(t == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.replace(lines, F.lit("\n"), F.lit("\n ")), F.lit("\n")))


def header(page_id: Column, ns: Column, rev_id: Column, parent: Column, timestamp: Column, user_id: Column, missing_parent: str = "") -> Column:
    """Archive header line. ``missing_parent`` is '' when built from dumps and '0' when built from the feed."""
    s = lambda c, default: F.coalesce(c.cast("string"), F.lit(default))
    user = F.when(s(user_id, "") == "", F.lit("0")).otherwise(user_id.cast("string"))
    return F.concat(
        F.lit("# page_id="), s(page_id, ""), F.lit(" ns="), s(ns, ""), F.lit(" rev_id="), s(rev_id, ""),
        F.lit(" parent_rev_id="), s(parent, missing_parent), F.lit(" timestamp="), s(timestamp, ""), F.lit(" user_id="), user, F.lit("\n"),
    )


def output_name(name: Column) -> Column:
    """Archive name of an input file: one known suffix off, the archive suffix on."""
    return F.concat(F.regexp_replace(name, r"\.(bz2|7z|xml)\z", ""), F.lit(".mwrev.zst"))


def daily_path(timestamp: Column) -> Column:
    return F.concat(F.lit("recentchanges/"), F.substring(timestamp, 1, 10), F.lit(".mwrev.zst"))


def parse_id(raw: Column, default: int | None = 0) -> Column:
    """Unsigned id of a raw string; ``default`` where it is not one."""
    v = F.when(raw.rlike(r"^\+?[0-9]+$"), raw.try_cast("long"))
    return v if default is None else F.coalesce(v, F.lit(default).cast("long"))


def parse_ns(raw: Column) -> Column:
    """Namespace number, which may be negative; 0 where unparseable."""
    return F.coalesce(F.when(raw.rlike(r"^[+-]?[0-9]+$"), raw.try_cast("int")), F.lit(0))


def byte_length(text: Column) -> Column:
    return F.octet_length(text).cast("long")


def joined_ids(ids: Column) -> Column:
    """Ids as the feed interface takes them: ascending, joined by ``|``."""
    return F.array_join(F.transform(F.array_sort(ids), lambda x: x.cast("string")), "|")
