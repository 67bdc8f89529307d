"""Per-key work without one task per key: ordered range partitions and stitched boundary states.

Rows are range-partitioned on (key, order) with sampled quantiles, so a key that holds most
rows spreads over many partitions, each a run of that key. Every partition
reduces its runs to partial states (one per key and partition); the states, at most keys + partitions
of them, are merged in partition order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def range_parts(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None) -> DataFrame:
    """Range partition on the composite of key and secondary order; ``__part`` is the partition's number.

    ``parts`` defaults to the session's shuffle partitions. NULL keys form a key of their own, first in order.
    """
    cols = [*keys, *order]
    out = df.repartitionByRange(parts, *cols) if parts else df.repartitionByRange(*cols)
    return out.withColumn("__part", F.spark_partition_id())


def group_states(df: DataFrame, keys: list[str], order: list[str], states: dict[str, Column], parts: int | None = None) -> DataFrame:
    """Partial states per key and range partition. The aggregate runs before its shuffle inside the range
    partition, so that shuffle carries one row per key and partition, however heavy the key.
    """
    return range_parts(df, keys, order, parts).groupBy(*keys, "__part").agg(*[v.alias(k) for k, v in states.items()])


def stitch(partial: DataFrame, keys: list[str], merged: dict[str, Column]) -> DataFrame:
    """Merge the states of each key over its partitions."""
    return partial.groupBy(*keys).agg(*[v.alias(k) for k, v in merged.items()])


def group_profile(df: DataFrame, key: str, order: str, size: str, parts: int | None = None) -> DataFrame:
    """Per key: ``n_rows``, ``first_order``, ``last_order``, ``total``, ``max_step``.

    ``total`` sums ``size`` (NULL counts 0, so an all-NULL key has 0); ``max_step`` is the largest gap between successive
    values of ``order`` (0 for a single row), which needs the key's rows in order: gaps inside a partition come from its rows,
    gaps across a border from the last value before and the first after it. Rows with NULL ``order`` count but make no gap.
    """
    rows = range_parts(df.select(F.col(key).alias("_k"), F.col(order).cast("long").alias("_o"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_s")), ["_k"], ["_o"], parts)

    def scan(batches):
        import numpy as np
        import pandas as pd

        low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        open_ = None  # the state of the run that the next batch may continue
        for pdf in batches:
            if not len(pdf):
                continue
            null = pdf["_k"].isna().to_numpy()
            k = pdf["_k"].fillna(0).to_numpy().astype(np.int64)
            none = pdf["_o"].isna().to_numpy()  # NULL orders come first in their key
            o = pdf["_o"].fillna(0).to_numpy().astype(np.int64)
            at = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]) | (null[1:] != null[:-1])])
            gap = np.zeros(len(k), np.int64)
            gap[1:] = np.where(none[1:] | none[:-1], 0, o[1:] - o[:-1])
            gap[at] = 0
            state = pd.DataFrame({
                "_k": k[at], "null": null[at], "n": np.diff(np.r_[at, len(k)]), "lo": np.minimum.reduceat(np.where(none, high, o), at),
                "hi": np.maximum.reduceat(np.where(none, low, o), at), "total": np.add.reduceat(pdf["_s"].to_numpy(), at), "step": np.maximum.reduceat(gap, at),
            })
            state["__part"] = int(pdf["__part"].iloc[0])
            if open_ is not None:
                first = state.iloc[0]
                if open_["_k"] == first["_k"] and open_["null"] == first["null"]:
                    both = open_["hi"] != low and first["lo"] != high
                    state.loc[0, ["n", "lo", "hi", "total", "step"]] = [
                        open_["n"] + first["n"], min(open_["lo"], first["lo"]), max(open_["hi"], first["hi"]), open_["total"] + first["total"],
                        max(open_["step"], first["step"], first["lo"] - open_["hi"] if both else 0),
                    ]
                else:
                    yield shown(pd.DataFrame([open_]))
            open_ = state.iloc[-1].to_dict()
            if len(state) > 1:
                yield shown(state.iloc[:-1])
        if open_ is not None:
            yield shown(pd.DataFrame([open_]))

    def shown(state):
        import numpy as np

        out = state.astype({c: "int64" for c in state.columns if c != "null"})
        key = out["_k"].astype("Int64").where(~state["null"].astype(bool))
        lo, hi = (out[c].astype("Int64").where(out[c] != getattr(np.iinfo(np.int64), end)) for c, end in (("lo", "max"), ("hi", "min")))
        return out.assign(_k=key, lo=lo, hi=hi)[cols]

    cols = ["_k", "__part", "n", "lo", "hi", "total", "step"]
    partial = rows.sortWithinPartitions("_k", "_o").mapInPandas(scan, "_k long, __part int, n long, lo long, hi long, total long, step long")
    w = Window.partitionBy("_k").orderBy("__part")  # at most one row per partition and key
    gaps = partial.withColumn("_gap", F.col("lo") - F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return gaps.groupBy(F.col("_k").alias(key)).agg(
        F.sum("n").alias("n_rows"), F.min("lo").alias("first_order"), F.max("hi").alias("last_order"), F.sum("total").alias("total"),
        F.greatest(F.max("step"), F.coalesce(F.max("_gap"), F.lit(0))).alias("max_step"),
    )


def heavy_keys(df: DataFrame, key: str, order: str, share: float, parts: int | None = None) -> DataFrame:
    """Keys, neither NULL nor 0, that hold at least ``share`` of all rows: (key, n_rows).

    All rows count in the total, NULL and 0 keys included; an empty table has no heavy keys.
    """
    rows = df.select(F.col(key).alias("_key"), F.col(order).alias("_order"))
    states = group_states(rows, ["_key"], ["_order"], {"_n": F.count("*")}, parts)
    counts = stitch(states, ["_key"], {"_rows": F.sum("_n")})
    total = counts.agg(F.sum("_rows").alias("_all")).scalar()
    return counts.filter((F.col("_key") != 0) & (F.col("_rows") >= total * share)).select(F.col("_key").alias(key), F.col("_rows").alias("n_rows"))


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, parts: int | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order``; with no keys, over the whole table.

    Rows are shuffled once, by range. Each range partition is sorted and summed where it lies and written, so that a retried task can't see other borders.
    What lies before a partition matters only for the key that it goes on with, so at most one sum a partition is added afterwards, by broadcast.
    Ties in ``order`` get some order of their own; NULL values count 0.
    """
    from palimpsest.session import stage

    cols, n, k = df.columns, len(df.columns), len(keys)
    rows = df.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)], *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.coalesce(F.col(value).cast("long"), F.lit(0)).alias("_v"),
    )
    names, sort = [f"_k{i}" for i in range(k)], [f"_o{i}" for i in range(len(order))]
    ranged = range_parts(rows, names, sort, parts).sortWithinPartitions(*names, *sort)
    ranged = ranged.select(*[f"_c{i}" for i in range(n)], *names, "__part", "_v")

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        last, total = None, 0  # key of the row before, and its sum
        for batch in batches:
            if not batch.num_rows:
                continue
            given, begin = [batch.column(n + i) for i in range(k)], np.zeros(batch.num_rows, bool)
            for c in given:
                a, b = c.slice(1), c.slice(0, len(c) - 1)
                other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
                begin[1:] |= other.to_numpy(zero_copy_only=False)
            begin[0] = last is None or tuple(c[0].as_py() for c in given) != last
            v = np.asarray(batch.column(n + k + 1), np.int64)
            sums, at = np.cumsum(v), np.flatnonzero(begin)
            run = sums - np.r_[-total, sums[at] - v[at]][np.cumsum(begin)]
            last, total = tuple(c[-1].as_py() for c in given), int(run[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(run)], [*batch.schema.names, "__run"])

    local, _ = stage(ranged.mapInArrow(scan, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields) + ", __run long"), "ranges")
    sums = local.groupBy("__part", *names).agg(F.sum("_v").alias("__sum"))
    before = Window.partitionBy(*names).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # rows: partitions, not records
    # Only a key that goes over the border of a partition has something before it there: a row a partition.
    base, _ = stage(sums.withColumn("__base", F.sum("__sum").over(before)).filter("__base IS NOT NULL").select(F.col("__part").alias("_p"), *[F.col(c).alias(f"_b{c}") for c in names], "__base"), "base")
    on = F.col("__part") == F.col("_p")
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_b{c}"))
    both = local.join(F.broadcast(base), on, "left")
    return both.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)], (F.col("__run") + F.coalesce("__base", F.lit(0))).cast("long").alias(out))
