"""References to records that do not exist: compressed bitmaps per key range and period, references AND-NOT live parents.

Keys are integers; ``dictionary`` encodes others. A bitmap covers 65,536 keys (the upper bits name the range) and is kept as
sorted 16-bit values below 4,096 keys, as 8 KB of bits from there on, so sparse and dense ranges both stay small.
Scan tasks make the bitmaps, one a task and range and period, so what is shuffled are distinct keys in compressed form, not rows: a hot key is
one bit of each task. The tasks' bitmaps of a range and period are then united before the ranges are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.session import maybe_broadcast, stage

ARRAY_LIMIT = 4096
_BITMAP = "field string, chunk long, kind int, period int, bits binary"


def pack(low) -> bytes:
    """Container of sorted distinct 16-bit values."""
    import numpy as np

    if len(low) < ARRAY_LIMIT:
        return low.astype("<u2").tobytes()
    bits = np.zeros(65536, np.uint8)
    bits[low] = 1
    return np.packbits(bits).tobytes()


def unpack(data: bytes):
    """65,536 flags of a container; a bitmap has 8,192 bytes, an array fewer."""
    import numpy as np

    if len(data) == 2 * ARRAY_LIMIT:
        return np.unpackbits(np.frombuffer(data, np.uint8)).astype(bool)
    flags = np.zeros(65536, bool)
    mark(flags, data)
    return flags


def mark(flags, data: bytes) -> None:
    """Set the flags of a container."""
    import numpy as np

    if len(data) == 2 * ARRAY_LIMIT:
        flags |= unpack(data)
    else:
        flags[np.frombuffer(data, "<u2")] = True


def dictionary(keys: DataFrame, column: str) -> DataFrame:
    """(column, code): dense integer codes of distinct non-NULL keys by their order, for keys that are not integers."""
    from palimpsest.operators.index import next_ids

    return next_ids(keys.filter(F.col(column).isNotNull()).select(column), column).withColumnRenamed("id", "code")


#: Containers a scan task holds before it hands them on, and keys in them (two bytes each).
HELD, HELD_KEYS = 8192, 1 << 24
_GROUP = ["field", "chunk", "kind", "period"]


def _joined(parts: list):
    """Sorted distinct values of sorted arrays."""
    import numpy as np

    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def _rows(held: dict):
    """Containers of groups, each given by arrays of its keys."""
    import pandas as pd

    return pd.DataFrame([(*g, pack(_joined(low))) for g, low in held.items()], columns=[*_GROUP, "bits"]).astype({"chunk": "int64", "period": "int32", "kind": "int32"})


def bitmaps(df: DataFrame) -> DataFrame:
    """Containers per (field, key range, period, kind) from rows (field, key, period int, kind int).

    A scan task merges all of its rows, so it gives one container a group unless it meets more than ``HELD`` groups or ``HELD_KEYS`` keys between two hand-overs.
    """

    def encode(batches):
        import numpy as np

        held: dict[tuple, list] = {}
        keys = 0
        for pdf in batches:
            if not len(pdf):
                continue
            names, f = np.unique(pdf["field"].to_numpy(dtype=str), return_inverse=True)
            key = pdf["key"].to_numpy(np.int64)
            group = np.stack([f.astype(np.int64), pdf["kind"].to_numpy(np.int64), pdf["period"].to_numpy(np.int64), key >> 16, key & 65535])
            g = group[:, np.lexsort(group[::-1])]
            g = g[:, np.r_[True, (g[:, 1:] != g[:, :-1]).any(0)]]
            at = np.r_[0, np.flatnonzero((g[:4, 1:] != g[:4, :-1]).any(0)) + 1, g.shape[1]]
            for a, b in zip(at[:-1], at[1:], strict=True):
                name, low = (names[g[0, a]], int(g[3, a]), int(g[1, a]), int(g[2, a])), g[4, a:b].astype(np.uint16)
                parts = held.setdefault(name, [])
                parts.append(low)
                keys += len(low)
                if len(parts) == 16:  # now and then, so that a hot range takes no more room than its distinct keys
                    keys -= sum(map(len, parts))
                    parts[:] = [_joined(parts)]
                    keys += len(parts[0])
            if len(held) >= HELD or keys >= HELD_KEYS:
                yield _rows(held)
                held, keys = {}, 0
        if held:
            yield _rows(held)

    return df.select("field", F.col("key").cast("long").alias("key"), F.col("period").cast("int").alias("period"), F.col("kind").cast("int").alias("kind")).mapInPandas(encode, _BITMAP)


def united(containers: DataFrame) -> DataFrame:
    """One container per (field, key range, kind, period).

    Containers of a group come one after another out of a sort, so a task holds the flags of one group however many tasks met it.
    """

    def unite(batches):
        import numpy as np

        open_, flags = None, None
        for pdf in batches:
            done = {}
            for field, chunk, kind, period, bits in pdf[[*_GROUP, "bits"]].itertuples(index=False, name=None):
                name = (field, chunk, kind, period)
                if name != open_:
                    if open_ is not None:
                        done[open_] = [np.flatnonzero(flags)]
                    open_, flags = name, np.zeros(65536, bool)
                mark(flags, bits)
            if done:
                yield _rows(done)
        if open_ is not None:
            yield _rows({open_: [np.flatnonzero(flags)]})

    return containers.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInPandas(unite, _BITMAP)


REFERENCE, PRESENT, DELETED = 0, 1, 2


def orphan_keys(references: DataFrame, parents: DataFrame, deleted: DataFrame) -> DataFrame:
    """(field, key, period): referred keys that no live parent has.

    ``references`` has (field, key, period), the others (field, key); keys are non-NULL integers, repeated rows count once.
    Per field and key range: references AND NOT (present AND NOT deleted), decoded to keys. What meets in a task is one
    container a period (8 KB at most), however many rows refer to the range.
    """
    zero = F.lit(0)
    rows = (
        references.select("field", "key", "period", F.lit(REFERENCE).alias("kind"))
        .unionByName(parents.select("field", "key", zero.alias("period"), F.lit(PRESENT).alias("kind")))
        .unionByName(deleted.select("field", "key", zero.alias("period"), F.lit(DELETED).alias("kind")))
    )

    def decode(key, pdf):
        import numpy as np
        import pandas as pd

        by = {kind: dict(zip(part["period"], part["bits"], strict=True)) for kind, part in pdf.groupby("kind")}
        none = np.zeros(65536, bool)
        present, deleted = (unpack(by[kind][0]) if kind in by else none for kind in (PRESENT, DELETED))
        dead, out = ~present | deleted, []
        for period, bits in by.get(REFERENCE, {}).items():
            low = np.flatnonzero(unpack(bits) & dead)
            out.append(pd.DataFrame({"field": key[0], "key": (np.int64(key[1]) << 16) + low, "period": np.int32(period)}))
        return pd.concat(out) if out else pd.DataFrame({"field": pd.Series([], dtype=str), "key": pd.Series([], dtype="int64"), "period": pd.Series([], dtype="int32")})

    return united(bitmaps(rows)).groupBy("field", "chunk").applyInPandas(decode, "field string, key long, period int")


def orphan_references(rows: DataFrame, fields: list[str], parents: DataFrame, deleted: DataFrame, keep: list[str]) -> DataFrame:
    """Distinct (ref_field, *keep, ref_id, period) of the rows whose reference in one of ``fields`` leads to no live parent.

    ``rows`` has the reference columns, ``keep`` and ``period`` (an integer, not NULL: -1 stands for unknown). NULL and 0 are no references. The
    orphan keys are joined back by broadcast only while their table is small; else the join shuffles, skew left to AQE.
    """
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("long").alias("key")) for f in fields])
    refs = rows.select(*kept, F.col("period").alias("period"), F.explode(pairs).alias("_r")).select("_r.field", "_r.key", "period", *[f"_keep{i}" for i in range(len(keep))]).filter("key <> 0")
    keys, path = stage(orphan_keys(refs, parents, deleted), "orphans")
    bad = maybe_broadcast(keys.select("field", "key", "period"), path)
    found = refs.join(bad, ["field", "key", "period"], "left_semi").distinct()
    return found.select(F.col("field").alias("ref_field"), *[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.col("key").alias("ref_id"), "period")
