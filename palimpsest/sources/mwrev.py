"""The line-framed revision archive ``*.mwrev.zst``: writer, reader and random access.

A record is a ``# key=value ...`` header line followed by body lines that begin with one blank.
Offsets and lengths count uncompressed bytes in every path.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

HEADER = re.compile(rb"# page_id=(.*?) ns=(.*?) rev_id=(.*?) parent_rev_id=(.*?) timestamp=(.*?) user_id=(.*?)\n\Z", re.S)
SCHEMA = "file string, seq long, page_id string, ns string, rev_id string, parent_rev_id string, timestamp string, user_id string, offset_begin long, length long, body string"


def _open(path: str):
    import zstandard

    return zstandard.ZstdDecompressor().stream_reader(open(path, "rb"), read_across_frames=True, closefd=True) if path.endswith(".zst") else open(path, "rb")  # noqa: SIM115


def records(path: str) -> Iterator[tuple]:
    """All records of one archive, streamed: memory holds one record."""
    import io

    name, at, seq, head, lines, begin = os.path.basename(path), 0, -1, None, [], 0
    with io.BufferedReader(_open(path), 1 << 20) as f:
        for line in f:
            if line.startswith(b"#"):
                if head:
                    yield (name, seq, *head, begin, at - begin, b"".join(lines).decode("utf-8", "replace"))
                m = HEADER.match(line)
                if not m:
                    raise ValueError(f"{path}: bad header at byte {at}")
                head, seq, lines = [x.decode("utf-8", "replace") for x in m.groups()], seq + 1, []
                begin = at + len(line)
            else:
                lines.append(line)
            at += len(line)
    if head:
        yield (name, seq, *head, begin, at - begin, b"".join(lines).decode("utf-8", "replace"))


def slice_of(path: str, offset: int, length: int) -> bytes:
    """The body at an indexed place: what (file_path, offset_begin, length) are for."""
    with _open(path) as f:
        while offset:
            got = f.read(min(offset, 1 << 20))
            if not got:
                return b""
            offset -= len(got)
        out = b""
        while length > len(out):
            got = f.read(length - len(out))
            if not got:
                break
            out += got
        return out


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        p = self.path
        found = [p] if os.path.isfile(p) else sorted(os.path.join(d, n) for d, _, names in os.walk(p) for n in names if n.endswith((".mwrev", ".mwrev.zst")))
        return [_File(x) for x in found] or [_File("")]

    def read(self, partition):
        if partition.path:
            yield from records(partition.path)


class MwrevSource(DataSource):
    """``spark.read.format("mwrev").load(path)``: one task per archive, a file or a folder of them."""

    @classmethod
    def name(cls):
        return "mwrev"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    spark.dataSource.register(MwrevSource)
    return spark.read.format("mwrev").load(path)


def unframe(body: F.Column) -> F.Column:
    """Lines of a body without their leading blank, joined by newlines."""
    return F.regexp_replace(F.regexp_replace(body, r"(?m)^ ", ""), r"\n\z", "")


class _Writer:
    """One open archive at a time: a temporary file that takes its name when the next one begins, so a retried task leaves no partial archive."""

    def __init__(self, out_dir: str):
        self.out_dir, self.name, self.out = out_dir, None, None

    def add(self, name: str, head: str, text: str) -> tuple[int, int]:
        """Write a record; returns the place of its body."""
        if name != self.name:
            self.close()
            self._open(name)
        h, t = head.encode("utf-8"), text.encode("utf-8")
        self.out.write(h)
        self.out.write(t)
        begin = self.size + len(h)
        self.size, self.records = begin + len(t), self.records + 1
        return begin, len(t)

    def _open(self, name: str) -> None:
        import zstandard

        self.name, self.size, self.records = name, 0, 0
        full = os.path.join(self.out_dir, name)
        os.makedirs(os.path.dirname(full), exist_ok=True)
        self.tmp = f"{full}.{uuid.uuid4().hex}.tmp"
        self.out = zstandard.ZstdCompressor(level=3).stream_writer(open(self.tmp, "wb"), closefd=True)  # noqa: SIM115

    def close(self) -> tuple | None:
        """Finish the open archive: (name, records, bytes)."""
        if self.out is None:
            return None
        self.out.close()
        self.out = None
        os.replace(self.tmp, os.path.join(self.out_dir, self.name))
        return self.name, self.records, self.size


def write_archives(framed: DataFrame, out_dir: str) -> DataFrame:
    """Write one archive per ``file_path`` from rows (file_path, seq, header, body) of any partitioning; returns (file_path, records, bytes).

    Texts are shuffled to one task per file; where rows come from a dump scan, ``archive_scan`` needs no shuffle. The work is done by an action here.
    """

    def write(batches):
        import pandas as pd

        w, done = _Writer(out_dir), []
        for pdf in batches:
            for path, head, text in zip(pdf["file_path"], pdf["header"], pdf["body"], strict=True):
                if path != w.name:
                    done.append(w.close())
                w.add(path, head, text)
        done.append(w.close())
        yield pd.DataFrame([x for x in done if x], columns=["file_path", "records", "bytes"])

    spark = framed.sparkSession
    rows = framed.select("file_path", "seq", "header", "body").repartition("file_path").sortWithinPartitions("file_path", "seq")
    done = rows.mapInPandas(write, "file_path string, records long, bytes long").collect()  # one row per file
    return spark.createDataFrame(done, "file_path string, records long, bytes long")


def archive_scan(framed: DataFrame, out_dir: str, keep: list[str]) -> DataFrame:
    """Archive the rows of a dump scan as they come and give ``keep``, ``offset_begin`` and ``length`` of each; rows whose ``pos`` is negative are no revisions and have no place.

    A dump file is one scan task that reads it in order, and shredding keeps both, so neither texts nor places are shuffled. Lazy: stage the result once.
    """

    def write(batches):
        import pandas as pd

        w = _Writer(out_dir)
        for pdf in batches:
            places = [w.add(p, h, b) if n >= 0 else (None, None) for p, h, b, n in zip(pdf["file_path"], pdf["header"], pdf["body"], pdf["pos"], strict=True)]
            out = pdf[keep].copy()
            for i, c in enumerate(("offset_begin", "length")):
                out[c] = pd.array([x[i] for x in places], "Int64")
            yield out
        w.close()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in framed.select(*keep).schema.fields)
    return framed.select(*dict.fromkeys([*keep, "pos", "file_path", "header", "body"])).mapInPandas(write, f"{fields}, offset_begin long, length long")


def append_frames(rows: list[tuple[str, str]], path: str, size: int = 0, stored: int = 0) -> list[tuple[int, int, int, int]]:
    """Append (header, body) records to a daily archive, one zstd frame each; returns begin, length, frame_offset, frame_length.

    ``rows`` holds one micro-batch of one day; ``size`` and ``stored`` are the archive's committed lengths, uncompressed and in the file. What stands
    beyond is left over from an attempt that failed and is cut off, so appending again gives the same places.
    """
    import zstandard

    os.makedirs(os.path.dirname(path), exist_ok=True)
    out, at = [], size
    with open(path, "r+b" if os.path.exists(path) else "w+b") as f:
        f.truncate(stored)
        f.seek(stored)
        for head, text in rows:
            data, frame_at = (head + text).encode("utf-8"), f.tell()
            f.write(frame := zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
            out.append((at + len(head.encode("utf-8")), len(text.encode("utf-8")), frame_at, len(frame)))
            at += len(data)
        f.flush()
        os.fsync(f.fileno())
    return out


class DailyArchives:
    """Committed lengths of the daily archives of an output folder, so that a batch that failed leaves nothing that counts.

    A batch asks ``begin`` for the lengths its archives are to be appended at, tells by ``prepare`` what it appended before its rows are committed to the
    index (or another sink), and calls ``commit`` after that. If it stops in between, the next ``begin`` asks the sink whether the rows are there. Kept is a line a day.
    """

    def __init__(self, out_dir: str):
        self.out_dir, self.path = out_dir, os.path.join(out_dir, "recentchanges", "_lengths.json")

    def _load(self) -> dict:
        if os.path.exists(self.path):
            with open(self.path) as f:
                return json.load(f)
        return {"files": {}, "pending": None}

    def _save(self, state: dict) -> None:
        os.makedirs(os.path.dirname(self.path), exist_ok=True)
        tmp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "w") as f:
            json.dump(state, f)
        os.replace(tmp, self.path)

    def _measured(self, name: str) -> tuple[int, int]:
        """Lengths of an archive that isn't known yet; one that was there before counts whole."""
        path, size = os.path.join(self.out_dir, name), 0
        if not os.path.exists(path):
            return 0, 0
        with _open(path) as f:
            while got := f.read(1 << 20):
                size += len(got)
        return size, os.path.getsize(path)

    def begin(self, names: list[str], committed) -> dict[str, tuple[int, int]]:
        """Lengths (uncompressed, stored) of the archives; ``committed(rev_id, file_path, offset_begin)`` tells whether the sink has a row."""
        state = self._load()
        if state["pending"]:
            if committed(*state["pending"]["mark"]):
                state["files"] |= state["pending"]["files"]
            state["pending"] = None
        for name in names:
            if name not in state["files"]:
                state["files"][name] = self._measured(name)
        self._save(state)
        return {n: tuple(state["files"][n]) for n in names}

    def prepare(self, lengths: dict[str, tuple[int, int]], mark: tuple[int, str, int]) -> None:
        self._save(self._load() | {"pending": {"files": lengths, "mark": mark}})

    def commit(self) -> None:
        state = self._load()
        if state["pending"]:
            self._save({"files": state["files"] | state["pending"]["files"], "pending": None})
