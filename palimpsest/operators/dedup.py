"""Exactly one copy of each message: a persisted index of sorted identifier arrays by hash prefix.

Each ingested batch is reduced to its first copies and shuffled by hash prefix; the task of a prefix reads the arrays that prefix has in
every run from the shared folder and looks the identifiers up by binary search, so the index itself is never shuffled.
The novel ones become a further immutable run. Runs are merged from time to time, prefix by prefix, without a shuffle.

A prefix is the upper bits of an identifier's hash, and arrays are in order of the hash, so runs of few and of many prefixes go
together: a shorter prefix holds a longer one as a slice. Every batch takes as many bits as its own size and the index need.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.session import publish, published, remove

#: Runs are merged when there are so many; a prefix should hold no more identifiers than this; least number of prefix bits.
MERGE_AT, PREFIX_IDS, LEAST_BITS = 3, 1_000_000, 4
_ARRAYS = ("h", "a", "b", "row")
_RUN = "bucket long, h binary, a binary, b binary, row binary, n long"


def bits_for(ids: int) -> int:
    """Prefix bits at which ``ids`` identifiers make arrays of at most about ``PREFIX_IDS``."""
    return max(LEAST_BITS, (max(ids, 1) // PREFIX_IDS).bit_length())


def tail(sizes: list[int]) -> int:
    """How many of the last runs to merge: an older run is taken in if what is merged already is at least half of it, so large runs are seldom written again."""
    count, total = 1, sizes[-1]
    while count < len(sizes) and (count < 2 or 2 * total >= sizes[-count - 1]):
        total += sizes[-count - 1]
        count += 1
    return count


def load(folder: str, held: int, bucket: int, bits: int, names=_ARRAYS[:3]):
    """Arrays of one prefix of ``bits`` bits out of a run that has prefixes of ``held`` bits, in order of the hash."""
    import numpy as np
    import pyarrow.parquet as pq
    from pyarrow.fs import FileSelector, FileSystem

    files, path = FileSystem.from_uri(folder)
    wanted = [bucket >> (bits - held)] if held <= bits else range(bucket << (held - bits), (bucket + 1) << (held - bits))
    parts = []
    for k in wanted:
        found = files.get_file_info(FileSelector(f"{path}/bucket={k}", allow_not_found=True))
        rows = [r for f in found if f.path.endswith(".parquet") for r in pq.ParquetFile(files.open_input_file(f.path)).read(list(names)).to_pylist()]
        parts += [[np.frombuffer(r[c], "<i8") for c in names] for r in rows]
    arrays = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * len(names)
    if held < bits:
        h = arrays[0].view(np.uint64) >> np.uint64(64 - bits)
        lo, hi = np.searchsorted(h, [bucket, bucket + 1])
        arrays = [x[lo:hi] for x in arrays]
    return arrays


def lookup(h, a, b, run):
    """Mask of the identifiers that are in a run (h, a, b): binary search on the hash, then exact comparison among equal hashes."""
    import numpy as np

    rh, ra, rb = run
    seen = np.zeros(len(h), bool)
    if not len(rh):
        return seen
    at, end = (np.searchsorted(rh.view(np.uint64), h.view(np.uint64), side) for side in ("left", "right"))
    while (open_ := ~seen & (at < end)).any():
        k = np.where(open_, at, 0)
        seen |= open_ & (ra[k] == a) & (rb[k] == b)
        at = at + 1
    return seen


def packed(bucket: int, h, a, b, row):
    """One row of arrays in order of hash and identifier."""
    import numpy as np
    import pandas as pd

    order = np.lexsort((b, a, h.view(np.uint64)))
    blob = lambda x: [x[order].astype("<i8").tobytes()]
    return pd.DataFrame({"bucket": [bucket], "h": blob(h), "a": blob(a), "b": blob(b), "row": blob(row), "n": [len(h)]})


class DedupIndex:
    """Identifiers (two 64-bit integers, compared exactly) seen so far, below ``root``.

    A batch is committed as one version; one that fails is taken again whole, and of two that are ingested at once the second raises ``Superseded``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _state(self) -> tuple[int, list[dict]]:
        number, text = published(self.spark, self.root)
        return number, json.loads(text) if text else []

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(f"{self.root}/{name}")

    @staticmethod
    def _prefix(bits: int) -> Column:
        return F.shiftrightunsigned("h", 64 - bits)

    def ingest(self, batch: DataFrame, a: str, b: str, row: str, rows: int | None = None) -> DataFrame:
        """Kept copies of the batch: (a, b, row) of identifiers not seen before, ``row`` the smallest of the batch.

        ``row`` identifies a delivery; ``rows`` is the size of the batch if the caller knows it. Rows with a NULL in ``a``, ``b`` or ``row`` are no messages and are not kept.
        Copies of a hot message meet map-side, so none of its rows gathers in a task, and a batch of any size is spread over enough prefixes. The result stays
        readable until ``vacuum``.
        """
        number, runs = self._state()
        name = f"run-{uuid.uuid4().hex}"
        given = batch.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"), F.col(row).cast("long").alias("row")).dropna()
        bits = bits_for(max(given.count() if rows is None else rows, sum(r["n"] for r in runs)))
        first = given.groupBy("a", "b").agg(F.min("row").alias("row")).withColumn("h", F.xxhash64("a", "b"))
        folders = [(f"{self.root}/{r['name']}", r["bits"]) for r in runs]

        def probe(key, pdf):
            bucket = int(key[0])
            h, x, y, z = (pdf[c].to_numpy() for c in _ARRAYS)
            seen = h != h
            for folder, held in folders:
                seen |= lookup(h, x, y, load(folder, held, bucket, bits))
            return packed(bucket, h[~seen], x[~seen], y[~seen], z[~seen])

        new = first.select(self._prefix(bits).alias("bucket"), *_ARRAYS)
        new.groupBy("bucket").applyInPandas(probe, _RUN).filter("n > 0").write.partitionBy("bucket").parquet(f"{self.root}/{name}")
        run = self._read(name)
        n = run.agg(F.sum("n")).first()[0] or 0
        number = publish(self.spark, self.root, number, json.dumps([*runs, {"name": name, "bits": bits, "n": n}]))
        if len(runs) + 1 >= MERGE_AT:
            self.merge(tail([*[r["n"] for r in runs], n]))

        def spread(batches):
            import numpy as np
            import pandas as pd

            for pdf in batches:
                for blobs in zip(pdf["a"], pdf["b"], pdf["row"], strict=True):
                    yield pd.DataFrame(dict(zip(("a", "b", "row"), (np.frombuffer(x, "<i8") for x in blobs), strict=True)))

        kept = run.select("a", "b", "row").mapInPandas(spread, "a long, b long, row long")
        return kept.select(F.col("a").alias(a), F.col("b").alias(b), F.col("row").alias(row))

    def merge(self, last: int | None = None) -> None:
        """Merge all runs, or so many of the last, into one: the task of a prefix takes its slices of all of them. Merged runs stay for readers until ``vacuum``."""
        number, old = self._state()
        runs = old[-last:] if last else old
        if not runs:
            return
        total, name = sum(r["n"] for r in runs), f"run-{uuid.uuid4().hex}"
        bits = bits_for(total)
        folders = [(f"{self.root}/{r['name']}", r["bits"]) for r in runs]

        def unite(batches):
            import numpy as np

            for pdf in batches:
                for bucket in pdf["id"].tolist():
                    h, a, b = (np.concatenate(x) for x in zip(*[load(folder, held, bucket, bits) for folder, held in folders], strict=True))
                    if len(h):
                        yield packed(bucket, h, a, b, np.empty(len(h), np.int64))[["bucket", "h", "a", "b", "n"]]

        tasks = min(1 << bits, max(self.spark.sparkContext.defaultParallelism, 1 << (bits - LEAST_BITS)))
        merged = self.spark.range(0, 1 << bits, 1, tasks).mapInPandas(unite, "bucket long, h binary, a binary, b binary, n long")
        merged.write.partitionBy("bucket").parquet(f"{self.root}/{name}")
        publish(self.spark, self.root, number, json.dumps([*old[: len(old) - len(runs)], {"name": name, "bits": bits, "n": total}]))

    def vacuum(self) -> None:
        """Remove what no published version needs; kept copies of earlier batches can't be read afterwards."""
        from palimpsest.session import fs

        f, p = fs(self.spark, self.root)
        live = {r["name"] for r in self._state()[1]}
        remove(self.spark, *[f"{self.root}/{n}" for n in (s.getPath().getName() for s in f.listStatus(p)) if n.startswith("run-") and n not in live])


def repeats(rows: DataFrame, kept: DataFrame, row: str) -> DataFrame:
    """Rows of ``rows`` that are not kept, by delivery: unique keys, so no message's copies gather. Rows without a delivery are left out."""
    return rows.select(row).filter(F.col(row).isNotNull()).join(kept.select(row), row, "left_anti")
